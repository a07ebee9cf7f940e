"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

Encoding reads a text once from left to right. The encoding of a prefix is the encoding of a shorter
prefix and one last token, namely the one token that ends there and keeps its neighbour: encoding the
bytes of both must give both. So each byte position needs only its last token. A later token can reach
back at most ``lookahead`` bytes, the longest token of the merge list less one; once all positions in
that window share their first tokens, these tokens are stable and are emitted. Memory is the window and
what is not stable yet, however long the text. Texts are cut at spaces into units that merges never
cross; units are memorised in a bounded table.

Decoding maps ids to bytes and runs an incremental UTF-8 state machine over chunks of ids; ill-formed
bytes become U+FFFD.

Nulls: a null text counts as empty and has no tokens. The special token's string in a text is that token.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm import common as C

#: Fixed value: the public pattern that cuts text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space that the unit-wise cut does not cover: such pieces are cut by the pattern alone.
ODD_SPACE = re.compile(r"[^\S\n ]|\s\s|\A\s|\s\Z|\x00")
MARKS = frozenset(".,;:!?)\"")
PIECE = 1 << 20  # characters of a text that are cut at once


def byte_letters() -> dict[str, int]:
    """Letter of the vocabulary file -> byte: printable Latin-1 stands for itself, the rest follows from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Transducer:
    """Tokens of one unit of text that merges do not cross."""

    def __init__(self, path: str):
        import ahocorasick
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {i: bytes(letter[c] for c in s) for s, i in spec["model"]["vocab"].items()}
        self.id = {b: i for i, b in self.bytes.items()}
        self.rank = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.id[bytes(letter[c] for c in a)], self.id[bytes(letter[c] for c in b)]] = r
        self.joined = {p: self.id[self.bytes[p[0]] + self.bytes[p[1]]] for p in self.rank}
        self.lookahead = max(map(len, self.id)) - 1
        self.ends = ahocorasick.Automaton()
        for b, i in self.id.items():
            self.ends.add_word(b.decode("latin-1"), (len(b), i))
        self.ends.make_automaton()
        #: When a token appears, and of which two it is made; single bytes are there from the start.
        self.born = {t: -1 for t in self.bytes}
        self.halves: dict[int, tuple[int, int]] = {}
        for pair, r in self.rank.items():
            token = self.joined[pair]
            if token not in self.halves or r < self.born[token]:
                self.born[token], self.halves[token] = r, pair
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: dict[bytes, tuple[int, bytes]] = {}

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the border of two tokens: undo their merges, the latest first, and
        look for a merge of the two tokens at the border that would have come before."""
        before = 1 << 60  # merges from this rank on are undone already
        while True:
            r = self.rank.get((left, right))
            if r is not None and r < before:
                return False
            a, b = self.born[left], self.born[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, self.halves[left][1]
            else:  # of two equal merges the left one comes first, so the right one is undone first
                before, right = b + (a == b or b >= 0), self.halves[right][0]

    def fits(self, left: int, token: int) -> bool:
        """``left`` and ``token`` stay apart side by side; left = -1: ``token`` is at the start."""
        known = self.pairs.get((left, token))
        if known is None:
            known = left < 0 or self._apart(left, token)
            if len(self.pairs) > 250_000:
                self.pairs.clear()
            self.pairs[left, token] = known
        return known

    def short(self, data: bytes) -> list[int]:
        """Tokens of a short unit. The last token of a prefix is a state of the transducer; states are kept
        (and dropped when there are many), as units share most of their prefixes."""
        return np.frombuffer(self.packed(data), "<u4").tolist()

    def packed(self, data: bytes) -> bytes:
        states, ids, fits = self.states, self.id, self.fits
        found = states.get(data)
        if found is not None:
            return found[1]
        if len(states) > 250_000:
            states.clear()
        n = known = len(data)
        while known and data[:known] not in states:
            known -= 1
        far = self.lookahead + 1
        for p in range(known + 1, n + 1):
            for a in range(p - far if p > far else 0, p):
                token = ids.get(data[a:p])
                if token is not None:
                    before, head = states[data[:a]] if a else (-1, b"")
                    if fits(before, token):
                        states[data[:p]] = token, head + token.to_bytes(4, "little")
                        break
        return states[data][1] if n else b""

    def encode(self, data: bytes) -> list[int]:
        if len(data) <= 32:
            return self.short(data)
        out: list[int] = []
        for part in self.stream([data]):
            out += part
        return out

    def stream(self, chunks):
        """Lists of stable tokens of the concatenated chunks, as they become known."""
        last, size = [-1], [0]  # last token of each prefix, from position ``base`` on
        base, want = 0, self.lookahead + 256
        at = 0
        for chunk in chunks:
            ending: dict[int, list] = {}
            text = chunk if at == 0 else tail + chunk
            shift = at - (len(text) - len(chunk))
            for end, token in self.ends.iter(text.decode("latin-1")):
                if shift + end >= at:
                    ending.setdefault(shift + end + 1, []).append(token)
            for p in range(at + 1, at + len(chunk) + 1):
                for n, token in sorted(ending.pop(p), reverse=True):
                    before = p - n - base
                    if before >= 0 and (last[before] >= 0 or p == n) and self.fits(last[before], token):
                        last.append(token)
                        size.append(n)
                        break
                if len(last) >= 2 * want:
                    stable, cut = self._stable(last, size)
                    if cut:
                        yield stable
                        base += cut
                        last, size = last[cut:], size[cut:]
            at += len(chunk)
            tail = text[-self.lookahead:]
        out, p = [], len(last) - 1
        while p > 0:
            out.append(last[p])
            p -= size[p]
        yield out[::-1]

    def _stable(self, last, size):
        """(tokens, position) up to which the encodings of all prefixes in the window agree."""
        def path(p):
            while p > 0:
                p -= size[p]
                yield p

        common = None
        for p in range(len(last) - 1 - self.lookahead, len(last)):
            mine = set(path(p)) | {p}
            common = mine if common is None else common & mine
        cut, out, p = max(common), [], max(common)
        while p > 0:
            out.append(last[p])
            p -= size[p]
        return out[::-1], cut


class Units(dict):
    """Unit of text -> its ids as little-endian 32-bit integers. Bounded: emptied when full.

    Keys: a word stands for the word after one space; with NUL before it, for the word at the start of a
    line; a newline for itself."""

    def __init__(self, path: str, most: int = 300_000):
        import regex
        super().__init__()
        self.cut, self.transducer, self.most = regex.compile(PATTERN), Transducer(path), most
        self.special = sorted(self.transducer.special, key=len, reverse=True)

    def ids_of(self, text: str) -> bytes:
        return b"".join(self.unit(m.group()) for m in self.cut.finditer(text))

    def unit(self, text: str) -> bytes:
        data = text.encode("utf-8")
        if len(data) <= 32:
            return self.transducer.packed(data)
        return b"".join(np.array(part, "<u4").tobytes() for part in self.transducer.stream([data]))

    def __missing__(self, key: str) -> bytes:
        text = key if key == "\n" else key[1:] if key[:1] == "\x00" else " " + key
        if text.isalpha() or key.isalpha():
            ids = self.unit(text)
        elif key[-1:] in MARKS and key[key[:1] == "\x00":-1].isalpha():
            ids = self[key[:-1]] + self.unit(key[-1])  # a word and one mark are two units
        else:
            ids = self.ids_of(text)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = ids
        return ids

    def encode(self, text: str):
        """Packed ids of ``text``, piece by piece."""
        for s in self.special:
            if s in text:
                for i, part in enumerate(text.split(s)):
                    if i:
                        yield np.array([self.transducer.special[s]], "<u4").tobytes()
                    yield from self.encode(part)
                return
        a = 0
        while a < len(text):
            b = text.find(" ", a + PIECE)
            while 0 < b < len(text) and (text[b - 1].isspace() or text[b + 1:b + 2].isspace() or b + 1 == len(text)):
                b = text.find(" ", b + 1)
            b = len(text) if b < 0 else b
            piece = text[a:b]
            body = piece if a == 0 else piece[1:]
            if body and not ODD_SPACE.search(body):
                if a == 0:
                    body = "\x00" + body
                yield b"".join(map(self.__getitem__, body.replace("\n", " \n \x00").split(" ")))
            else:
                yield self.ids_of(piece)
            a = b


class Decoder:
    """Ids to text, chunk by chunk."""

    def __init__(self, transducer: Transducer):
        top = max([*transducer.bytes, *transducer.special.values()])
        self.table = [transducer.bytes.get(i, b"") for i in range(top + 1)]
        for s, i in transducer.special.items():
            self.table[i] = s.encode()

    def decode(self, packed: bytes, step: int = 1 << 16):
        state = codecs.getincrementaldecoder("utf-8")("replace")
        ids = np.frombuffer(packed, "<u4")
        for a in range(0, len(ids), step):
            yield state.decode(b"".join(map(self.table.__getitem__, ids[a:a + step].tolist())))
        yield state.decode(b"", True)


def loaded(path: str) -> tuple[Units, Decoder]:
    """Tables of a vocabulary file, once for each worker process."""
    def build():
        units = Units(path)
        return units, Decoder(units.transducer)
    return C.held(("bpe", path), build)


def _coded(column, units, decoder):
    """(packed ids, whether they decode to the text) of the texts of a column."""
    texts = C.as_text(column).to_pylist()
    ids = [b"".join(units.encode(t)) for t in texts]
    return pa.array(ids, pa.binary()), pa.array([_decodes_to(decoder, p, t) for p, t in zip(ids, texts)], pa.bool_())


def encode(docs: DataFrame, path: str, keep: tuple = ()) -> DataFrame:
    """doc_id, the columns ``keep``, ids (packed little-endian 32-bit integers), lossless (whether the ids
    decode to the text)."""
    def run(batches):
        units, decoder = loaded(path)
        for part in (p for batch in batches for p in C.slices(batch, 1)):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *part.columns[2:], *_coded(part.column(1), units, decoder)],
                names=["doc_id", *keep, "ids", "lossless"])

    C.ship(docs.sparkSession)
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
            .mapInArrow(run, f"doc_id long, {kept}ids binary, lossless boolean"))


def _decodes_to(decoder: Decoder, packed: bytes, text: str) -> bool:
    at = 0
    for part in decoder.decode(packed):
        if not text.startswith(part, at):
            return False
        at += len(part)
    return at == len(text)


def decode(encoded: DataFrame, path: str, keep: tuple = ()) -> DataFrame:
    """doc_id, the columns ``keep``, text, from doc_id and packed ids."""
    def run(batches):
        _, decoder = loaded(path)
        for batch in batches:
            text = ["".join(decoder.decode(x or b"")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(text, pa.string())],
                                             names=["doc_id", *keep, "text"])

    C.ship(encoded.sparkSession)
    kept = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in keep)
    return encoded.select("doc_id", "ids", *keep).mapInArrow(run, f"doc_id long, {kept}text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text decoded from them, chunk by chunk."""
    def run(batches):
        units, decoder = loaded(path)
        for batch in (p for whole in batches for p in C.slices(whole, 1, 500, 1 << 24)):
            rows = []
            for text in C.as_text(batch.column(1)).to_pylist():
                packed = b"".join(units.encode(text))
                back = hashlib.sha256()
                for part in decoder.decode(packed):
                    back.update(part.encode())
                rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), back.hexdigest()))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    C.ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark, sf_dir):
    return digests(C.scan(spark, sf_dir, "documents"), vocabulary())


def bpe_stage(spark, docs, sf_dir):
    """Pipeline stage: every document encoded; adds n_tokens and ids, in place of columns that have these
    names already, and keeps the documents whose ids decode to their text (all of them, as the coding is
    lossless; a null text counts as empty and stays null). Other columns stay, whatever their names."""
    keep = [i for i, c in enumerate(docs.columns) if c.lower() not in ("n_tokens", "ids")]
    chosen = docs.select(*[f"`{docs.columns[i]}`" for i in keep])
    at, path = chosen.columns.index("text"), vocabulary()
    C.record_batches(docs.sparkSession, 1000)
    schema = T.StructType(chosen.schema.fields + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        units, decoder = loaded(path)
        for part in (p for batch in batches for p in C.slices(batch, at)):
            ids, same = _coded(part.column(at), units, decoder)
            n = pc.divide(pc.binary_length(ids).cast(pa.int64()), 4)
            yield pa.RecordBatch.from_arrays([*part.columns, n, ids], names=schema.fieldNames()).filter(same)

    C.ship(docs.sparkSession)
    return chosen.mapInArrow(run, schema)
