"""SentencePiece encoding and decoding by a streaming Viterbi pass.

For every boundary of the text the pass keeps one surviving path: the best
sequence of pieces that ends there, as a back pointer. A boundary can still be
extended while the text behind it is the beginning of a piece, so for at most
``longest`` characters. Whenever the back pointers of all boundaries that can be
extended lead to one boundary, everything before it is final: its ids are
committed and its pointers dropped.

What makes a path survive depends on the model. In a unigram model it is the
sum of piece scores. In a BPE model a path is the one that merging would give
for that prefix, which is so when every piece merges to itself and every two
neighbours stay apart when merged alone; exactly one path survives at each
boundary, and the result equals merging the whole text.

White space becomes U+2581, one is put before a text that isn't empty, and
characters without a piece become byte pieces (or the unknown piece where the
model has none). No piece holds U+2581 after another character, so paths always
converge before one, and what was committed up to the next is remembered for
the next time, up to a bound.

Defined results: a null text gives null ids, an empty one no ids; decoding null
ids gives null. A U+2581 in a text decodes to a space, as in any model that
escapes spaces this way. Extra columns are carried through.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from adloom.llm.words import slices
from adloom.llm.workspace import spare_name

SPACE = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Stretches of each of two generations, and half the pairs of pieces, that a worker remembers: about 200 bytes each.
REMEMBERED = 400_000

_STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Vocabulary:
    """Pieces, scores and special ids of a model file, read with the installed library."""

    def __init__(self, model: bytes, unigram: bool = False):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.unigram = unigram
        self.ids = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.unknown = sp.unk_id()
        self.bytes = [-1] * 256
        self.out: list[bytes] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            else:
                self.out.append(b"" if sp.is_control(i) else piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.ids))
        lowest = min(self.scores.values(), default=0.0)
        self.unknown_score = lowest - 10.0
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in self.ids)


def _tree(pieces) -> dict[str, tuple[dict, bool]]:
    """The pieces as a tree: by letter, the letters that may follow, and whether a piece ends here."""
    root: dict = {}
    for piece in sorted(pieces):  # a piece comes before those that it begins
        node = root
        for letter in piece[:-1]:
            node = node.setdefault(letter, ({}, False))[0]
        node[piece[-1]] = ({}, True)
    return root


class Remembered(dict):
    """A dict that computes missing values; when it is full, what the generation before knew and nobody asked for is forgotten."""

    def __init__(self, of):
        super().__init__()
        self.of, self.before = of, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.of(key)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.whole = {} if vocabulary.unigram else {p: s for p, s in vocabulary.scores.items() if self.merged(p) == [p]}
        self.apart: dict[str, dict[str, bool]] = defaultdict(dict)
        self.pairs = 0
        self.starts = _tree(vocabulary.scores if vocabulary.unigram else self.whole)
        self.stretches = Remembered(lambda text: np.array(self.stream(text), np.int32).tobytes())

    # --- encoding

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        text = SPACE + text.replace(" ", SPACE)
        if not self.v.splits:
            return np.array(self.stream(text), np.int32).tobytes()
        return b"".join(map(self.stretches.__getitem__, _STRETCH.findall(text)))

    def merged(self, text: str) -> list[str]:
        """BPE of a short string by definition: merge the best neighbours, the leftmost of equals, until none is a piece."""
        parts, scores = list(text), self.v.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stay_apart(self, a: str, b: str) -> bool:
        """Whether merging a + b alone gives a and b: the two are whole, so it does unless a merge crosses between them."""
        self.pairs += 1
        if self.pairs > 2 * REMEMBERED:
            self.apart.clear()
            self.pairs = 0
        parts, scores, border = list(a + b), self.v.scores, len(a)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0 or at == border - 1:
                self.apart[a][b] = found = at < 0
                return found
            border -= at < border
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stream(self, text: str) -> list[int]:
        """Ids of ``text``, committing whenever the surviving paths have converged."""
        v, out, start = self.v, [], self.starts
        unigram, apart, longest = v.unigram, self.apart, v.longest
        base = 0  # boundary up to which ids are committed; lists begin there
        before: list[str | None] = [None]  # last piece of the path that ends at each boundary
        total = [0.0]
        live: list[tuple[int, dict]] = [(0, start)]  # boundaries that can be extended, the last first, and the letters they want
        check = longest
        end = 0
        for letter in text:
            newest, end = end, end + 1
            best, best_total, still = None, 0.0, []
            for begin, wanted in live:
                found = wanted.get(letter)
                if found is None:
                    if begin != newest:
                        continue
                    piece = letter  # no piece begins so: a character may always stand alone
                else:
                    wanted, whole = found
                    if wanted:
                        still.append((begin, wanted))
                    if best is not None and not unigram or not whole and begin != newest:
                        continue
                    piece = text[begin:end]
                if unigram:
                    score = total[begin - base] + v.scores.get(piece, v.unknown_score)
                    if best is None or score > best_total:
                        best, best_total = piece, score
                elif best is None:  # the shortest piece that stays apart from the one before it
                    last = before[begin - base]
                    if last is not None:
                        fits = apart[last].get(piece)
                        if not (self.stay_apart(last, piece) if fits is None else fits):
                            continue
                    best = piece
            before.append(best)
            total.append(best_total)
            if best is not None:
                meet = not still
                still.insert(0, (end, start))
            else:
                meet = False
            live = still
            if meet or end - base >= check:
                base, before, total = self.commit(out, base, before, total, [begin for begin, _ in live])
                check = max(longest, end - base + 4)
        self.flush(out, before, len(before) - 1, 0)
        return out

    def commit(self, out: list[int], base: int, before: list, total: list, live: list[int]):
        """Commit up to the last boundary that the paths to all ``live`` boundaries go through, if that is past ``base``."""
        at = {i - base for i in live}
        while len(at) > 1:
            far = max(at)
            at.discard(far)
            at.add(far - len(before[far]))
        cut = at.pop()
        if cut <= 0:
            return base, before, total
        self.flush(out, before, cut, 0)
        # The boundary keeps its last piece, which decides what may follow it.
        return base + cut, before[cut:], total[cut:]

    def flush(self, out: list[int], before: list, end: int, begin: int) -> None:
        parts = []
        while end > begin:
            parts.append(before[end])
            end -= len(before[end])
        for piece in reversed(parts):
            i = self.v.ids.get(piece)
            if i is not None:
                out.append(i)
                continue
            raw = [self.v.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
            out.extend(raw if min(raw) >= 0 else [self.v.unknown])

    # --- decoding

    def decode(self, ids: list[int]) -> str:
        """The text; bytes that are not UTF-8 become U+FFFD."""
        text = b"".join(map(self.v.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_codecs: dict[tuple, Codec] = {}


def codec(model: bytes, unigram: bool = False) -> Codec:
    """One codec per model and Python worker."""
    key = (hash(model), len(model), unigram)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(Vocabulary(model, unigram))
    return _codecs[key]


def read_model(spark: SparkSession, path: str) -> bytes:
    """The model file (a few MB at most), read through Spark, so any store will do."""
    plain = path if "://" in path or path.startswith("file:") else f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(plain).select("content").first()[0])


def _lists(blobs: list[bytes | None]) -> pa.Array:
    sizes = np.array([len(b) // 4 if b is not None else 0 for b in blobs], np.int64)
    flat = pa.array(np.frombuffer(b"".join(b for b in blobs if b is not None), np.int32))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    mask = pa.array(np.array([b is None for b in blobs], bool))
    return pa.ListArray.from_arrays(pa.array(ends), flat, mask=mask)


def encode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", unigram: bool = False) -> DataFrame:
    """``docs`` with the ids of ``text`` in a last column ``ids``; with an underscore before it where a column has that name."""
    at, ids = docs.columns.index(text), spare_name(docs, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                blobs = [None if t is None else codec(model, unigram).encode(t) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(blobs)], [*part.schema.names, ids])

    schema = StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the text of ``ids`` in a last column ``text``; with an underscore before it where a column has that name."""
    at, text = docs.columns.index(ids), spare_name(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = codec(model)
            texts = [None if x is None else c.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    schema = StructType([*docs.schema.fields, StructField(text, StringType())])
    return docs.mapInArrow(run, schema)


def encoded_digest(docs: DataFrame, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """Per document: doc_id, n_ids, ids_sha256 (of the little-endian 32-bit ids) and whether decoding gives the text again."""
    model = read_model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        c = codec(model)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    blob = c.encode(text or "")
                    back = c.decode(np.frombuffer(blob, np.int32).tolist())
                    rows.append((doc, len(blob) // 4, hashlib.sha256(blob).hexdigest(), back == (text or "").replace(SPACE, " ")))
                columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids_sha256", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_sha256 string, round_trip boolean")
