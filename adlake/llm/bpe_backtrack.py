"""SentencePiece BPE encoding by backtracking, and decoding.

The encoding of a text is the only sequence of vocabulary pieces that covers it
and in which every two neighbours stay as they are when their concatenation is
merged again.  So no merge queue over the text is needed: from the left, take
the longest piece that an Aho-Corasick automaton finds at the place; if it is
not compatible with the piece before, try the next shorter one; if none fits,
step back.  A flag for every position that failed once keeps the search from trying it again.

Texts fall into segments that no piece can cross: pieces hold U+2581 only in
front or alone, and a code point that is in no piece becomes byte pieces by
itself.  Each worker keeps the encodings of segments that it has met lately, at most
``cache_size`` of them (about 100 MB), in two halves of which the older goes, and
four times as many verdicts on pairs of pieces (about 140 MB), emptied when full.

Decoding joins the pieces, turns U+2581 into spaces, removes the one space that
the encoder put in front, and reads runs of byte pieces as UTF-8; a byte that is
no valid UTF-8 becomes U+FFFD.

Plan: one scan, no shuffle.  The model (half a megabyte) is read once on the
driver and broadcast as bytes.

Defined results: null counts as the empty text, with no ids; repeated rows and
rows with a null doc_id are encoded each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import in_batches, read_table

QUERY_NAME = "op10_bpe_backtrack"

SPACE = "▁"
CACHE_SIZE = 300_000
NEVER = float("-inf")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message; 32-bit values stay as bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            n = 4 if key & 7 == 5 else 8
            if key & 7 == 2:
                n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        yield key >> 3, value


class Pieces:
    """The vocabulary of a SentencePiece BPE model (identity normaliser, byte fallback) and its coder."""

    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

    def __init__(self, model: bytes, cache_size: int = CACHE_SIZE) -> None:
        import struct

        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.dummy_prefix, self.collapse_spaces, self.escape = True, True, True
        for number, value in _fields(model):
            if number == 1:
                got = dict(_fields(value))
                self.pieces.append(got[1].decode())
                scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
                self.kinds.append(got.get(3, self.NORMAL))
            elif number == 3:
                spec = dict(_fields(value))
                self.dummy_prefix, self.collapse_spaces, self.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
                if spec.get(1, b"identity") != b"identity" or spec.get(2):
                    raise ValueError("only the identity normaliser is known")
        if self.collapse_spaces or not self.escape or self.USER in self.kinds:
            raise ValueError("this model trims spaces or has user-defined pieces")
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == self.BYTE}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == self.NORMAL}
        self.unknown = self.kinds.index(self.UNKNOWN)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece crosses a space")
        #: Order of merging: by falling score; equal scores merge from the left, whatever the piece.
        self._order = {p: scores[i] for p, i in self.ids.items()}
        self.letters = {c for p in self.ids for c in p}
        self.matcher = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.matcher.add_word(p, i)
        self.matcher.make_automaton()
        self.cache_size = cache_size
        self._bytes = [self._decoded(i) for i in range(len(self.pieces))]
        self._decimal = [str(i) for i in range(len(self.pieces))]
        self._lengths = [len(p) for p in self.pieces]
        #: The longest other piece that a piece begins with, or -1.
        self._shorter = [next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), -1) for p in self.pieces]
        self._cache = _Segments(self, cache_size)
        self._pairs: dict[int, bool] = {}
        # a line break is in no piece of the models at hand; it then parts segments as well, so that more of them recur
        end = "" if "\n" in self.letters else "\n"
        self._split = re.compile(f"{SPACE}*[^{SPACE}{end}]+|{SPACE}+(?!{SPACE})" + "|\n" * bool(end), re.S)

    def remerge(self, text: str) -> list[str]:
        """Merge from single code points: the best-scored adjacent pair first, the leftmost of equals. Only short texts come here."""
        parts, order = list(text), self._order
        ranks = [order.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = max(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = order.get(parts[at] + parts[at + 1], NEVER)
            if at:
                ranks[at - 1] = order.get(parts[at - 1] + parts[at], NEVER)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' concatenation again gives just these two; left is -1 where a segment begins."""
        if len(self._pairs) >= 4 * self.cache_size:
            self._pairs.clear()
        pair = [self.pieces[i] for i in (left, right) if i >= 0]
        known = self._pairs[left << 32 | right] = self.remerge("".join(pair)) == pair
        return known

    def search(self, text: str) -> list[int]:
        """Ids of a segment whose code points are all in the vocabulary."""
        lengths, pairs, shorter = self._lengths, self._pairs, self._shorter
        # the leftmost longest pieces: if all neighbours fit, no other encoding exists
        path, last, at, n = [], -1, 0, len(text)
        for end, i in self.matcher.iter_long(text):
            if end + 1 - lengths[i] != at:
                break
            fits = pairs.get(last << 32 | i)
            if fits is None:
                fits = self.compatible(last, i)
            if not fits:
                break
            path.append(i)
            last, at = i, end + 1
        if at == n:
            return path
        # the search goes on from there; shorter pieces that begin with the longest of a position follow from the vocabulary
        longest = [-1] * n
        for end, i in self.matcher.iter(text):
            longest[end + 1 - lengths[i]] = i  # by rising end, so the longest comes last
        failed = bytearray(n + 1)  # a flag for each position from which the rest can't be covered
        i = longest[at]
        while at < n:
            while i >= 0:
                if not failed[at + lengths[i]]:
                    fits = pairs.get(last << 32 | i)
                    if fits is None:
                        fits = self.compatible(last, i)
                    if fits:
                        break
                i = shorter[i]
            if i >= 0:
                path.append(i)
                at += lengths[i]
                last = i
                if at < n:
                    i = longest[at]
            else:
                if not path:
                    raise ValueError(f"no encoding of {text!r}")
                failed[at] = 1
                at -= lengths[last]
                i = shorter[path.pop()]
                last = path[-1] if path else -1
        return path

    def segment_ids(self, segment: str) -> list[int]:
        if self.letters.issuperset(segment):
            return self.search(segment)
        ids: list[int] = []
        run = 0
        for k, c in enumerate(segment):
            if c not in self.letters:
                if k > run:
                    ids += self.search(segment[run:k])
                if self.bytes:
                    ids += [self.bytes[b] for b in c.encode()]
                else:
                    ids.append(self.unknown)
                run = k + 1
        return ids + self.search(segment[run:]) if run < len(segment) else ids

    def normal(self, text: str) -> str:
        return (SPACE + text if self.dummy_prefix and text else text).replace(" ", SPACE)

    def encode(self, text: str) -> list[int]:
        return [i for s in self._split.findall(self.normal(text)) for i in self.segment_ids(s)]

    def decode(self, ids: list[int]) -> str:
        said = [i for i in ids if self.kinds[i] != self.CONTROL]
        return self._finish(self._raw(ids), bool(said) and self.pieces[said[0]].startswith(SPACE))

    def _raw(self, ids: list[int]) -> bytes:
        return b"".join([self._bytes[i] for i in ids])

    def _decoded(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == self.BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if kind == self.UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == self.CONTROL else self.pieces[i].replace(SPACE, " ").encode()

    def _finish(self, raw: bytes, spaced: bool) -> str:
        """*spaced*: the first piece begins with a space, which the encoder put there."""
        text = _utf8(raw)
        return text[1:] if self.dummy_prefix and spaced else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids joined by commas, and of the decoded text; segments are remembered."""
        parts = [self._cache[s] for s in self._split.findall(self.normal(text))]
        ids = ",".join([p[0] for p in parts])
        decoded = self._finish(b"".join([p[1] for p in parts]), bool(text))
        return ids.count(",") + bool(ids), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


class _Segments(dict):
    """Decimal ids joined by commas, and decoded bytes, of the short segments met lately: when full, it becomes the older half, from which segments that recur come back."""

    def __init__(self, pieces: Pieces, size: int) -> None:
        super().__init__()
        self.pieces, self.half = pieces, size // 2
        self.older: dict[str, tuple[str, bytes]] = {}

    def __missing__(self, segment: str) -> tuple[str, bytes]:
        got = self.older.get(segment)
        if got is None:
            ids = self.pieces.segment_ids(segment)
            got = ",".join([self.pieces._decimal[i] for i in ids]), self.pieces._raw(ids)
        if len(segment) <= 64:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[segment] = got
        return got


def _utf8(raw: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that is in no valid sequence."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode())
            out.append("�")
            at += e.start + 1
    return "".join(out)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_LOADED: dict[bytes, Pieces] = {}


def coder(model: bytes) -> Pieces:
    """The coder of a model, one for each worker process."""
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def encode_documents(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids (array of int) and the decoded text of each document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(held.value)
        for batch in batches:
            for a in range(0, len(batch), 200):
                rows = batch.slice(a, 200)
                ids = [pieces.encode(t or "") for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(pieces.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), apply, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(held.value)
        for batch in batches:
            for a in range(0, len(batch), 500):
                rows = batch.slice(a, 500)
                n, ids, decoded = zip(*(pieces.digest(t or "") for t in rows.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), apply, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(read_table(spark, sf_dir, "documents"), load_model(model_path()))
