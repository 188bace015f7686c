"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

The vocabulary's pattern never lets a token cross from a character that is no white space to one
that is, so texts can be cut there without changing a token. Long text without such a place is
cut into halves, again and again; the pieces are encoded in parallel by different tasks and
joined in pairs. Around each join a window is encoded anew and grows until it agrees with
the left side in one token and with the right side in another. A sequence of tokens is the
encoding of its text if each two neighbours are, so the joined sequence is exact.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import shuffle_partitions, text_of
from cartlake.sources.scratch import materialize

# Characters that one call encodes; longer texts are cut into pieces and spread over tasks.
PIECE = 16_384
WINDOW = 64
# Python knows more white space than the pattern does; these four are white space to both.
_SPACE = re.compile(r"\S(?=[ \t\n\r])")
# The public pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others get code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """A byte-level vocabulary read from a tokenizer file, special tokens included."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters = _byte_letters()
        vocab = {bytes(letters[c] for c in t): i for t, i in data["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        plain = {b: i for b, i in vocab.items() if i not in self.special.values()}
        self.core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=plain, special_tokens={})
        self.bytes = {i: b for b, i in plain.items()} | {i: t.encode() for t, i in self.special.items()}
        self.width = np.zeros(max(self.bytes, default=0) + 1, np.int64)
        for i, b in self.bytes.items():
            self.width[i] = len(b)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not any(name in text for name in self.special):
            return self.core.encode_ordinary(text)
        out: list[int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self.core.encode_ordinary(part)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(spec: str) -> Codec:
    return Codec(spec)


def cuts(text: str, limit: int, special: tuple[str, ...] = ()) -> list[tuple[int, bool]]:
    """Where to cut ``text`` into pieces of ``limit`` characters at most, and whether the cut
    is between tokens in any case. Without such a place in reach it is cut in the middle of the
    stretch, by halves; never inside a special token."""
    out: list[tuple[int, bool]] = []

    def halves(low: int, high: int) -> None:
        if high - low <= limit:
            return
        middle = (low + high) // 2
        for name in special:
            found = text.rfind(name, max(low, middle - len(name) + 1), middle + len(name) - 1)
            if found >= 0 and found < middle < found + len(name):
                middle = found
        if not low < middle < high:
            return
        halves(low, middle)
        out.append((middle, False))
        halves(middle, high)

    start = 0
    while len(text) - start > limit:
        last = None
        for m in _SPACE.finditer(text, start, start + limit):
            last = m.end()
        if last is None:
            m = _SPACE.search(text, start + limit - 1)
            last = m.end() if m else len(text)
            halves(start, last)
        if last < len(text):
            out.append((last, True))
        start = last
    return out


def _boundary(data: bytes, at: int) -> int:
    """The start of the character that holds byte ``at``."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def join(left: np.ndarray, right: np.ndarray, code: Codec, window: int = WINDOW) -> np.ndarray:
    """The encoding of the joined text from the encodings of its two parts.

    A window around the join is encoded anew. If it shares a token with the left part and one
    with the right part, what lies between them is taken from the window and the rest from
    the parts. Otherwise the window doubles; in the end it is the whole text.
    """
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    ends_l, ends_r = np.cumsum(code.width[left]), np.cumsum(code.width[right])
    total_l, total_r = int(ends_l[-1]), int(ends_r[-1])
    while True:
        # Tokens from the left that reach back ``window`` bytes, and from the right alike.
        a = int(np.searchsorted(ends_l, total_l - window, "right"))
        b = min(int(np.searchsorted(ends_r, window, "left")) + 1, len(right))
        whole_l, whole_r = a == 0, b == len(right)
        from_l = int(ends_l[a - 1]) if a else 0
        to_r = int(ends_r[b - 1])
        data = b"".join(code.bytes[i] for i in left[a:].tolist())
        mid = len(data)
        data += b"".join(code.bytes[i] for i in right[:b].tolist())
        first, last = 0, len(data)
        while first < mid and data[first] & 0xC0 == 0x80:
            first += 1
        if not whole_r:
            last = _boundary(data, _last_start(data))
        ids = np.array(code.encode(data[first:last].decode("utf-8", "replace")), np.int64)
        if whole_l and whole_r:
            return ids
        ends = np.cumsum(code.width[ids]) + from_l + first
        starts = ends - code.width[ids]
        cut_l = 0 if whole_l else _shared(left, ends_l, ids, starts, ends, total_l)
        cut_r = len(ids) if whole_r else _shared_right(right, ends_r + total_l, ids, starts, ends, total_l)
        if cut_l is not None and cut_r is not None:
            i = 0 if whole_l else cut_l
            keep_l = left[:0] if whole_l else left[: int(np.searchsorted(ends_l, ends[i], "left")) + 1]
            j = cut_r
            keep_r = right[:0] if whole_r else right[int(np.searchsorted(ends_r + total_l, ends[j], "left")) :]
            middle = ids[(0 if whole_l else i + 1) : j]
            if whole_l or whole_r or i < j:
                return np.concatenate([keep_l, middle, keep_r])
        window *= 2


def _last_start(data: bytes) -> int:
    """Where the last character starts if it is cut off, else the end."""
    at = len(data) - 1
    while at > 0 and data[at] & 0xC0 == 0x80:
        at -= 1
    lead = data[at]
    need = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    return len(data) if len(data) - at == need else at


def _shared(side, side_ends, ids, starts, ends, join_at) -> int | None:
    """The last token of the window that ends before the join and is also one of ``side``.
    The first token of the window is none, as its left neighbours are not seen."""
    at = np.searchsorted(side_ends, ends)
    known = (at < len(side)) & (ends <= join_at)
    at = np.minimum(at, len(side) - 1)
    same = known & (side_ends[at] == ends) & (side[at] == ids)
    same[:1] = False
    found = np.flatnonzero(same)
    # One token of distance to the join, where the left part was cut off.
    found = found[ends[found] < join_at]
    return int(found[-1]) if len(found) else None


def _shared_right(side, side_ends, ids, starts, ends, join_at) -> int | None:
    """The first token of the window that starts after the join and is also one of ``side``."""
    at = np.searchsorted(side_ends, ends)
    known = (at < len(side)) & (starts > join_at)
    at = np.minimum(at, len(side) - 1)
    same = known & (side_ends[at] == ends) & (side[at] == ids)
    same[-1:] = False
    found = np.flatnonzero(same)
    return int(found[0]) if len(found) else None


def tree_join(parts: list[np.ndarray], safe: list[bool], code: Codec) -> np.ndarray:
    """Join neighbours in pairs, level by level. Across a safe cut nothing is encoded anew."""
    while len(parts) > 1:
        joined, between = [], []
        for i in range(0, len(parts), 2):
            if i + 1 < len(parts):
                pair = parts[i : i + 2]
                joined.append(np.concatenate(pair) if safe[i] else join(*pair, code))
            else:
                joined.append(parts[i])
            if i + 1 < len(safe):
                between.append(safe[i + 1])
        parts, safe = joined, between
    return parts[0]


def encode_long(text: str, code: Codec, limit: int) -> np.ndarray:
    """What the distributed path does with one text, in one place; for tests."""
    places = cuts(text, limit, tuple(code.special))
    at = [0, *(p for p, _ in places), len(text)]
    parts = [np.array(code.encode(text[a:b]), np.int64) for a, b in zip(at, at[1:])]
    return tree_join(parts, [s for _, s in places], code)


def _outcome(ids: np.ndarray, code: Codec) -> tuple[bytes, str]:
    return ids.astype("<u4").tobytes(), code.decode(ids.tolist())


def encode_documents(
    docs: DataFrame,
    spec: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece: int = PIECE,
    summary: bool = False,
) -> DataFrame:
    """``id, n_tokens, ids, decoded``, one row per row of ``docs``.

    ``spec`` is the content of a byte-level tokenizer file. ``ids`` holds the token ids as
    little-endian unsigned 32-bit integers and ``decoded`` the text that they decode to. Special
    tokens written in a text count as such. NULL texts are empty; empty texts have no tokens.
    Equal ids and repeated rows are each encoded. With ``summary`` the two large columns
    are given as SHA-256 (``ids_sha256``, ``decoded_sha256``). Empty tables give no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(spec)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    wide = F.length("text") > piece
    kind = "n_tokens bigint, ids binary, decoded string"
    if summary:
        kind = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    names = [c.split()[0] for c in kind.split(", ")]

    def results(found: list[tuple[bytes, str]]) -> list[pa.Array]:
        n = pa.array([len(a) // 4 for a, _ in found], pa.int64())
        if summary:
            ids = pa.array([hashlib.sha256(a).hexdigest() for a, _ in found], pa.string())
            text = [hashlib.sha256(t.encode()).hexdigest() for _, t in found]
        else:
            ids, text = pa.array([a for a, _ in found], pa.binary()), [t for _, t in found]
        return [n, ids, pa.array(text, pa.string())]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(shared.value)
        for batch in batches:
            found = []
            for text in batch.column(1):
                found.append(_outcome(np.array(code.encode(text.as_py()), np.int64), code))
            yield pa.RecordBatch.from_arrays([batch.column(0), *results(found)], ["id", *names])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = tuple(codec(shared.value).special)
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places = cuts(text, piece, special)
                at = [0, *(p for p, _ in places), len(text)]
                parts = [text[a:b] for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest] * len(parts)),
                        pa.array(range(len(parts)), pa.int32()),
                        pa.array([True, *(s for _, s in places)], pa.bool_()),
                        pa.array(parts, pa.string()),
                    ],
                    ["digest", "part", "safe", "text"],
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(shared.value)
        for batch in batches:
            ids = [np.array(code.encode(t.as_py()), "<u4").tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(ids, pa.binary())], ["digest", "part", "safe", "ids"]
            )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(shared.value)
        for batch in batches:
            found = []
            for parts in batch.column(1).to_pylist():
                ids = [np.frombuffer(p["ids"], "<u4").astype(np.int64) for p in parts]
                found.append(_outcome(tree_join(ids, [p["safe"] for p in parts[1:]], code), code))
            yield pa.RecordBatch.from_arrays([batch.column(0), *results(found)], ["digest", *names])

    one_go = rows.where(~wide).mapInArrow(short, f"id {rows.schema['id'].dataType.simpleString()}, {kind}")
    # Long texts are found again by their digest, so equal ones are encoded once.
    long_rows, _ = materialize(rows.where(wide).withColumn("digest", F.sha2("text", 256)), "long-texts")
    once = long_rows.groupBy("digest").agg(F.any_value("text").alias("text"))
    spread = once.mapInArrow(pieces, "digest string, part int, safe boolean, text string").repartition(
        shuffle_partitions(docs), "digest", "part"
    )
    parts = spread.mapInArrow(encoded, "digest string, part int, safe boolean, ids binary")
    # The pieces of one text only: bounded by the longest text.
    trees = parts.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("part", "safe", "ids"))).alias("parts"))
    trees = trees.mapInArrow(joined, f"digest string, {kind}")
    by_tree = long_rows.select("id", "digest").join(trees, "digest").select("id", *names)
    return one_go.unionByName(by_tree)


def read_spec(path: str) -> str:
    """A tokenizer file's content; a public vocabulary, a few MB."""
    with open(path, encoding="utf-8") as f:
        return f.read()
