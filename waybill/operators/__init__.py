"""One module per family; every public function takes and returns DataFrames."""
