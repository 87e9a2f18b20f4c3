"""BPE encoding and decoding with a contiguous rank array.

The vocabulary file gives byte-level tokens, ordered merges and special tokens. A text is cut
at special tokens, then into words by the file's split pattern. A short word keeps the parts
between its boundaries and the rank of each adjacent pair in contiguous arrays; the smallest
rank is scanned for again and again, its boundary deleted and the two neighbouring ranks
refreshed (``Bpe._scan``, which takes many words at a time). Words longer than ``SHORT_BYTES``
use a heap over linked parts instead, which joins in the same order (smallest rank, then
leftmost) without the quadratic scan. Each task remembers units (a space and what follows up
to the next) it has encoded, in a table of bounded size.

Defined results: null and empty texts have no tokens (empty ids, empty text). Repeated rows each
get their row; an empty table gives none; extra columns are ignored by ``encode``. Decoding
joins the tokens' bytes and reads them as UTF-8, invalid bytes as U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Split pattern of the byte-level vocabulary (fixed value of its format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT_BYTES = 64
#: Encoded units that a task remembers (about 200 bytes each) and rows of one table of words.
CACHED = 1 << 19
TABLE_ROWS = 1 << 14
NO_RANK = 1 << 20
#: Characters of text that are encoded together.
TOGETHER = 1 << 20
#: A space before white space, and units that begin at a space before other characters.
SPACES = regex.compile(r" (?=\s)")
UNIT = regex.compile(r"(?: (?=\S)|(?! (?=\S)).)(?:(?! (?=\S)).)*", regex.DOTALL)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


class Bpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, content: str, cached: int = CACHED):
        spec = json.loads(content)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        as_bytes = {token: bytes(letters[c] for c in token) for token in vocab}
        self.token_bytes: dict[int, bytes] = {i: as_bytes[token] for token, i in vocab.items()}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for token, i in vocab.items():
            if len(as_bytes[token]) == 1:
                self.byte_ids[as_bytes[token][0]] = i
        merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            merges.setdefault(vocab[left] << 20 | vocab[right], (rank, vocab[left + right]))
        self.pairs = np.array([*sorted(merges), np.iinfo(np.int64).max], dtype=np.int64)
        self.ranks = np.array([merges[k][0] for k in sorted(merges)] + [NO_RANK], dtype=np.int32)
        self.merged = np.zeros(NO_RANK + 1, dtype=np.int32)  # by rank
        for rank, i in merges.values():
            self.merged[rank] = i
        self.merges = merges
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self.token_bytes |= {i: text.encode() for text, i in self.special.items()}
        self.words = regex.compile(PATTERN)
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.cached = cached
        self.cache: dict[str, bytes] = {}  # int32 ids of each unit

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of joining two adjacent parts (NO_RANK where there is no merge)."""
        key = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_RANK)

    def _scan(self, words: list[bytes]) -> list[bytes]:
        """Parts of short words: one row a word, all rows a step at a time.

        Row r holds the part ids between its boundaries, and beside them the ranks of adjacent
        parts. Each step finds every row's smallest rank (the leftmost of equals), deletes that
        boundary by closing the row up, and refreshes the ranks left and right of it.
        """
        width = max(map(len, words))
        table = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(len(words), width)
        size = np.array([len(w) for w in words])
        ids = self.byte_ids[table]
        ranks = self._rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(words), 1), NO_RANK, dtype=np.int32)
        ranks[np.arange(ranks.shape[1]) >= size[:, None] - 1] = NO_RANK
        row = np.arange(len(words))
        while len(row):
            part, rank = ids[row], ranks[row]
            k = rank.argmin(axis=1)
            n = np.arange(len(row))
            best = rank[n, k]
            live = best < NO_RANK
            row, part, rank, k, best = row[live], part[live], rank[live], k[live], best[live]
            if not len(row):
                break
            n = np.arange(len(row))
            size[row] -= 1
            behind = np.arange(width) > k[:, None]
            part[:, :-1] = np.where(behind[:, :-1], part[:, 1:], part[:, :-1])
            part[n, k] = self.merged[best]
            gone = behind[:, : rank.shape[1]] | (np.arange(rank.shape[1]) == k[:, None])
            rank[:, :-1] = np.where(gone[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NO_RANK
            after = k + 1 < size[row]
            rank[n[after], k[after]] = self._rank(part[n[after], k[after]], part[n[after], k[after] + 1])
            before = k > 0
            rank[n[before], k[before] - 1] = self._rank(part[n[before], k[before] - 1], part[n[before], k[before]])
            ids[row], ranks[row] = part, rank
        flat, stride = ids.tobytes(), 4 * width
        return [flat[at : at + 4 * n] for at, n in zip(range(0, len(flat), stride), size.tolist())]

    def _heap(self, word: bytes) -> list[int]:
        """Parts of a long word: a heap of ranks over linked parts."""
        ids, n = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist(), len(word)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]

        def look(a: int, b: int) -> tuple[int, int] | None:
            return self.merges.get(ids[a] << 20 | ids[b])

        heap = [(found[0], k) for k in range(n - 1) if (found := look(k, k + 1))]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if ids[k] < 0 or right < 0 or not (found := look(k, right)) or found[0] != rank:
                continue
            ids[k], ids[right] = found[1], -1
            after[k] = after[right]
            if after[k] >= 0:
                before[after[k]] = k
                if found := look(k, after[k]):
                    heapq.heappush(heap, (found[0], k))
            if before[k] >= 0 and (found := look(before[k], k)):
                heapq.heappush(heap, (found[0], before[k]))
        return [i for i in ids if i >= 0]

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """Part ids (as int32 bytes) of split words; rows of similar length share a table."""
        out: dict[str, bytes] = {}
        widths: dict[int, tuple[list[str], list[bytes]]] = {}
        for word in words:
            data = word.encode("utf-8")
            if len(data) > SHORT_BYTES:
                out[word] = np.array(self._heap(data), dtype=np.int32).tobytes()
            else:
                same = widths.setdefault(max(4, (len(data) + 3) // 4 * 4), ([], []))
                same[0].append(word)
                same[1].append(data)
        for same, data in widths.values():
            for lo in range(0, len(same), TABLE_ROWS):
                out.update(zip(same[lo : lo + TABLE_ROWS], self._scan(data[lo : lo + TABLE_ROWS])))
        return out

    def _learn(self, units: set[str]) -> None:
        """Put the ids of new units into the cache."""
        whole, cut = [], {}
        for unit in units:
            if unit.isalpha() or (unit[:1] == " " and unit[1:].isalpha()):
                whole.append(unit)  # a space and letters are one word
            else:
                cut[unit] = self.words.findall(unit)
        words = self._words({*whole, *chain.from_iterable(cut.values())})
        ids_of = words.__getitem__
        self.cache.update(zip(whole, map(ids_of, whole)))
        self.cache.update((unit, b"".join(map(ids_of, ws))) for unit, ws in cut.items())

    def _units(self, text: str) -> list[str]:
        """Cut before each space that a non-space follows: no split word crosses such a place."""
        if SPACES.search(text):
            return UNIT.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]] if first else [" " + r for r in rest]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text. The texts' new words are merged together."""
        parts: list[list[list[str] | int]] = []  # units between special tokens, or a special token's id
        for text in texts:
            cut = self.cut.split(text) if self.cut else (text,)
            parts.append([self.special[part] if n % 2 else self._units(part) for n, part in enumerate(cut)])
        cache = self.cache
        new = {u for of in parts for units in of if not isinstance(units, int) for u in units if u not in cache}
        if new:
            self._learn(new)
        ids_of, out = cache.__getitem__, []
        for of in parts:
            joined = [np.int32(u).tobytes() if isinstance(u, int) else b"".join(map(ids_of, u)) for u in of]
            out.append(np.frombuffer(b"".join(joined), dtype=np.int32).tolist())
        # The cache is emptied when it is full and never keeps long units beyond this call.
        for unit in new:
            if len(unit) > SHORT_BYTES:
                del cache[unit]
        if len(cache) > self.cached:
            cache.clear()
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")



def _read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _each_batch(spark: SparkSession, vocabulary: str):
    """A function that gives a task its encoder; the file's text travels as one broadcast."""
    content = _read_vocabulary(vocabulary)
    shared, key = spark.sparkContext.broadcast(content), hashlib.sha256(content.encode()).hexdigest()

    def encoder() -> Bpe:
        # Spark reuses its Python workers: the next task finds the encoder and its cache here.
        held = sys.modules.setdefault("_bpe_encoders", types.ModuleType("_bpe_encoders")).__dict__
        if key not in held:
            held[key] = Bpe(shared.value)
        return held[key]

    return encoder


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``TOGETHER`` bytes of text (column 1), one row at least."""
    sizes = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column(1)), 0), dtype=np.int64))
    lo = 0
    while lo < batch.num_rows:
        start = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, start + TOGETHER, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of each document: (id_col, ids array<int>)."""
    encoder = _each_batch(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or encoder()
            for part in pieces(batch):
                ids = bpe.encode_all([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of token ids: (id_col, text)."""
    encoder = _each_batch(encoded.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or encoder()
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [bpe.decode(ids or []) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids: (doc_id, n_tokens, ids_sha256, decoded_sha256) in one pass.

    The ids stay inside the task, since only their digests are asked for.
    """
    encoder = _each_batch(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            if bpe is None:
                bpe = encoder()
                decimal = [str(i) for i in range(max(bpe.token_bytes) + 1)]
            for part in pieces(batch):
                n, hashed, decoded = [], [], []
                for ids in bpe.encode_all([t or "" for t in part.column(1).to_pylist()]):
                    n.append(len(ids))
                    hashed.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_vocabulary() -> str:
    """Path of the byte-level vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, default_vocabulary())
