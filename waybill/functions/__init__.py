from .columns import (blank, bounded, code_units, digest, normalized_code, ratio_floor,
                      wire_json)

__all__ = ["blank", "bounded", "code_units", "digest", "normalized_code",
           "ratio_floor", "wire_json"]
