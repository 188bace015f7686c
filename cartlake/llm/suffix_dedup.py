"""Removal of byte strings that occur again, by merging suffix orders of shards.

Whether a string of ``WINDOW`` bytes starts twice is found by merged Burrows-Wheeler transforms
(``bwt``). Most text never gets there: a string's rarest part, the anchor, is the place where a hash
of a few bytes is least, so equal strings have their anchor at the same distance. Strings that
share an anchor and a range of distances share a core of bytes in their middle, and only
pieces whose core occurs in another piece can hold a repeated string. All others are left out without
loss. Pieces of equal content are merged once, however often they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.bwt import BLOCK, repeated_windows
from cartlake.llm.common import located, shuffle_partitions, text_of
from cartlake.sources.scratch import materialize

WINDOW = 400
# Bytes whose hash chooses the anchor.
GRAM = 16
# Distances from the anchor that one piece covers.
SPAN = 128
# Pieces of one core that a task merges; beyond that they are cut into single strings.
CORE_PIECES = 512
# Bytes of pieces that a task merges at once, and of each shard of them. A task takes some 150 bytes of
# memory per byte of pieces: 80 MB, and 40 more where the last core is crowded.
MERGE_BYTES = 1 << 19
SHARD_BYTES = 1 << 17
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _gram_hashes(data: bytes) -> np.ndarray:
    """32-bit hashes of the ``GRAM`` bytes from each place on."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).astype(np.uint64)
    h = words[:n] * _MIX
    h ^= h >> np.uint64(29)
    h += words[GRAM - 8 : GRAM - 8 + n]
    h *= _MIX2
    return h >> np.uint64(32)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(values)
    pad = -n % width
    rows = np.concatenate([values, np.full(pad, values.max(initial=0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(back[:m], ahead[width - 1 : width - 1 + m])


def pieces(data: bytes, window: int = WINDOW, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``starts, counts, core_starts, ranges``: runs of strings that share anchor and distance range.

    Piece ``i`` holds the strings that start at ``starts[i]`` and the ``counts[i] - 1`` next
    places. All of them cover the ``window - span + 1`` bytes from ``core_starts[i]`` on.
    """
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none, none
    h = _gram_hashes(data)
    keyed = (h << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding_least(keyed, window - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    part = (anchor - np.arange(len(anchor))) // span
    first = np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]
    starts = np.flatnonzero(first)
    counts = np.diff(np.r_[starts, len(anchor)])
    return starts, counts, anchor[starts] - span * part[starts], part[starts]


def _cores(data: bytes, window: int, span: int):
    starts, counts, cores, parts = pieces(data, window, span)
    size, digest = window - span + 1, xxhash.xxh3_64_intdigest
    hashes = [digest(data[c : c + size], p) for c, p in zip(cores.tolist(), parts.tolist())]
    return np.array(hashes, np.uint64).view(np.int64), starts, counts


def _find_cores(window: int, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, cores, starts, counts = [], [], [], []
            texts = zip(batch.column(0).to_pylist(), batch.column(1))
            size = 0
            for key, text in texts:
                c, s, n = _cores(text.as_py().encode(), window, span)
                keys += [key] * len(c)
                cores.append(c)
                starts.append(s)
                counts.append(n)
                size += len(c)
                if size > 200_000:
                    yield _core_rows(keys, cores, starts, counts)
                    keys, cores, starts, counts, size = [], [], [], [], 0
            if size:
                yield _core_rows(keys, cores, starts, counts)

    return run


def _core_rows(keys, cores, starts, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(cores)),
            pa.array(keys, pa.binary()),
            pa.array(np.concatenate(starts).astype(np.int32)),
            pa.array(np.concatenate(counts).astype(np.int32)),
        ],
        ["core", "key", "start", "strings"],
    )


def _cut_pieces(window: int, span: int):
    """The candidate pieces of each text, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [])
            size = 0
            for key, text, list_of in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                for p in list_of.as_py():
                    a, n = p["start"], p["strings"]
                    content = data[a : a + n + window - 1]
                    for column, v in zip(out, (p["core"], key, a, content)):
                        column.append(v)
                    size += len(content)
                if size > 8 << 20:
                    yield _piece_rows(out)
                    out, size = ([], [], [], []), 0
            if out[0]:
                yield _piece_rows(out)

    return run


def _piece_rows(out) -> pa.RecordBatch:
    core, key, start, content = out
    digests = [xxhash.xxh3_128_digest(c) for c in content]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(core, pa.int64()),
            pa.array(key, pa.binary()),
            pa.array(start, pa.int32()),
            pa.array(digests, pa.binary()),
            pa.array(content, pa.binary()),
        ],
        ["core", "key", "start", "digest", "content"],
    )


def _merge_pieces(window: int):
    """Over rows sorted by core: which strings of each piece start in another one too."""

    def settle(digests: list[bytes], contents: list[bytes]) -> pa.RecordBatch:
        found = repeated_windows(contents, window, SHARD_BYTES)
        rows = []
        for digest, starts in zip(digests, found):
            if len(starts):
                cut = np.flatnonzero(np.diff(starts) > 1)
                for a, b in zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist()):
                    rows.append((digest, a, b))
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.binary(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["digest", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, contents, size, last = [], [], 0, None
        for batch in batches:
            for core, digest, content in zip(*(c.to_pylist() for c in batch.columns)):
                if core != last and size > MERGE_BYTES:
                    yield settle(digests, contents)
                    digests, contents, size = [], [], 0
                digests.append(digest)
                contents.append(content)
                size += len(content)
                last = core
        if digests:
            yield settle(digests, contents)

    return run


def _single_strings(window: int):
    """The strings of pieces, one by one, by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(content) - window + 1
                strings = [xxhash.xxh3_128_digest(content[i : i + window]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest] * n, pa.binary()), pa.array(range(n), pa.int32()), pa.array(strings, pa.binary())],
                    ["digest", "low", "string"],
                )

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its runs."""
    for batch in batches:
        rows = []
        for key, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            data = text.as_py().encode()
            kept, at, merged = [], 0, []
            for a, b in sorted((r["first"], r["last"]) for r in runs):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            for a, b in merged:
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            rest = b"".join(kept)
            rows.append((key, len(data) - len(rest), len(merged), rest))
        key, removed, spans, rest = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key, pa.binary()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(rest, pa.binary()),
                pa.array([hashlib.sha256(r).hexdigest() for r in rest], pa.string()),
            ],
            ["key", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def repeated_pieces(texts: DataFrame, window: int, span: int) -> DataFrame:
    """``key, pieces``: of each text (``key, text``) the pieces whose core is in another piece too.

    Copies of a text have the same key, so a copy's pieces are those of the text and not others.
    """
    rows = texts.mapInArrow(_find_cores(window, span), "core bigint, key binary, start int, strings int")
    place = F.xxhash64("key", "start")
    least, most = F.min(place), F.max(place)
    shared = rows.groupBy("core").agg(least.alias("least"), most.alias("most")).where("least <> most")
    shared, _ = materialize(shared.select("core"), "shared-cores")
    piece = F.struct("core", "start", "strings")
    return rows.join(shared, "core", "left_semi").groupBy("key").agg(F.collect_set(piece).alias("pieces"))


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    span: int = SPAN,
    id_col: str = "doc_id",
    text_col: str = "text",
    core_pieces: int = CORE_PIECES,
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept, kept_sha256``, one row per row of ``docs``.

    Texts are read as UTF-8 bytes. Each byte is removed that is covered by a ``window``-byte string
    which starts anywhere else too, in the same or another row, as the input has it; ``kept``
    holds the other bytes in order, NULL where nothing was removed. ``n_spans`` counts maximal
    removed runs. NULL texts are empty; texts shorter than a window stay whole; of equal texts
    that are as long all is removed. NULL and repeated ids do not matter, each row counts. An
    empty table gives no rows. ``window`` must be a multiple of the block that ``bwt`` reads.
    """
    if window % BLOCK:
        raise ValueError(f"the window must be a multiple of {BLOCK}")
    n = shuffle_partitions(docs)
    rows = located(docs).select(
        F.col(f"`{id_col}`").alias("id"),
        text_of(text_col).alias("text"),
        F.col("__file").alias("file"),
        F.col("__row").alias("row"),
    )
    rows = rows.withColumn("key", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    narrow, _ = materialize(
        rows.select("id", "key", "file", "row", F.octet_length("text").cast("bigint").alias("n_bytes")), "text-keys"
    )
    texts = narrow.groupBy("key").agg(F.min(F.struct("file", "row")).alias("at"), F.count(F.lit(1)).alias("copies"))
    long_rows = rows.where(F.octet_length("text") >= window)
    candidates, _ = materialize(repeated_pieces(long_rows.select("key", "text"), window, span), "repeated-pieces")
    # Each text once, at the place of its first copy.
    wanted = candidates.join(texts, "key").select("at.file", "at.row", "pieces", "copies")
    found, _ = materialize(
        long_rows.select("key", "text", "file", "row").join(wanted, ["file", "row"]).drop("file", "row"),
        "repeating-texts",
    )
    cut = found.select("key", "text", "pieces").mapInArrow(
        _cut_pieces(window, span), "core bigint, key binary, start int, digest binary, content binary"
    )
    cut, _ = materialize(cut, "pieces")
    # Equal pieces meet before they move; they are repeated as a whole.
    contents = cut.groupBy("core", "digest").agg(F.any_value("content").alias("content"), F.count(F.lit(1)).alias("n"))
    contents, _ = materialize(contents, "piece-contents")
    per_core = contents.groupBy("core").agg(F.count(F.lit(1)).alias("pieces"))
    # A piece that is alone with its core has no string in common with another one, nor twice
    # itself: equal strings have their anchors at the same distance.
    cores, seen = materialize(
        per_core, "piece-cores", {"n": F.count_if(F.col("pieces") > core_pieces)}, keep=F.col("pieces") > 1
    )
    quiet, strings = "digest binary, low int, high int", "digest binary, low int, string binary"
    crowded = F.col("pieces") > core_pieces
    calm = contents.join(cores.where(~crowded).select("core"), "core", "left_semi")
    dealt = calm.select("core", "digest", "content").repartition(n, "core").sortWithinPartitions("core", "digest")
    runs = dealt.mapInArrow(_merge_pieces(window), quiet)
    if seen["n"]:
        # Of very many pieces around one core, strings that are equal meet before they move.
        single = (
            contents.join(cores.where(crowded).select("core"), "core", "left_semi")
            .select("digest", "content")
            .repartition(n, "digest")
            .mapInArrow(_single_strings(window), strings)
        )
        single, _ = materialize(single, "single-strings")
        again = single.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
        again, _ = materialize(again, "repeated-strings")
        runs = runs.unionByName(
            single.join(again, "string", "left_semi").select("digest", "low", F.col("low").alias("high"))
        )
    whole = contents.where("n > 1").select(
        "digest", F.lit(0).alias("low"), (F.octet_length("content") - window).alias("high")
    )
    runs, _ = materialize(runs.unionByName(whole), "repeated-runs")
    covered = (
        cut.select("key", "start", "digest")
        .join(runs, "digest")
        .select(
            "key",
            (F.col("start") + F.col("low")).alias("first"),
            (F.col("start") + F.col("high") + window).alias("last"),
        )
    )
    per_text = covered.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    left = (
        found.select("key", "text")
        .join(per_text, "key")
        .mapInArrow(_remove, "key binary, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
    )
    copies = texts.where("copies > 1").select("key", F.lit(True).alias("copied"))
    out = narrow.select("id", "key", "n_bytes").join(left, "key", "left").join(copies, "key", "left")
    gone = F.col("copied") & (F.col("n_bytes") >= window)
    nothing = F.lit(b"")
    return out.select(
        "id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, nothing).otherwise(F.col("kept")).alias("kept"),
        F.when(gone, F.sha2(nothing, 256))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("key"))))
        .alias("kept_sha256"),
    )
