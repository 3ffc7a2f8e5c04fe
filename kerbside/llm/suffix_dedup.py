"""Removal of long repeated byte strings with suffix arrays and longest-previous-factor arrays.

A string of ``LENGTH`` bytes repeats if it starts anywhere else, in any document. Every
window of that length picks an anchor by its contents alone: the rightmost of its smallest
16-byte hashes. Equal windows pick equal anchors at equal places, so they meet in the
group of the anchor's hash. Consecutive windows with one anchor are one context. Equal
contexts are counted before any bytes are moved; where an anchor has several different
contexts, a suffix array over these gives, by previous and next smaller positions in suffix
order, the longest factor that also starts earlier (and, mirrored, later) for each window.
Anchors with very many different contexts are split further, to blocks of windows and where
needed to single ones, which are counted.

Removed are all copies, or all but the first one by key and place (``keep_first``).

Defined cases: a null text counts as empty; texts below ``LENGTH`` bytes lose nothing; matches
never cross texts; repeated rows are copies of each other; rows with a null id take part and
are cleaned as well, each by its own text: rows are told apart by key, hash and size of the text.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.graphs import stored
from kerbside.llm.texts import keyed, mixed

LENGTH, GRAM = 400, 16
#: Windows of a text worked on at once.
PIECE_WINDOWS = 1 << 20
#: Different contexts of an anchor above which it is split.
SPLIT = 512
#: Windows of a block when an anchor is split.
BLOCK = 16
#: Bytes of contexts in one suffix array.
ARRAY_BYTES = 1 << 20


# Anchors


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each ``GRAM`` consecutive bytes."""
    word = data.astype(np.uint64)
    for step in (1, 2, 4):
        word = word[:-step] | word[step:] << np.uint64(8 * step)
    return mixed(mixed(word[8:]) + word[:-8])


def rightmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the rightmost smallest value in each window of ``width``, by running minima over blocks."""
    n = len(values)
    places = np.uint64((1 << 26) - 1) - np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << 26) - 1)
    keyed_values = (values & ~low) | places
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = keyed_values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    return (low - (best & low)).astype(np.int64)


def contexts(raw: bytes) -> list[tuple[int, int, int]]:
    """(anchor hash, first byte, bytes) of each run of windows with one anchor."""
    out = []
    for at in range(0, len(raw) - LENGTH + 1, PIECE_WINDOWS):
        data = np.frombuffer(raw[at:at + PIECE_WINDOWS + LENGTH - 1], np.uint8)
        hashes = gram_hashes(data)
        anchor = rightmost_smallest(hashes, LENGTH - GRAM + 1)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        size = np.diff(np.append(first, len(anchor))) + LENGTH - 1
        out += zip(hashes[anchor[first]].view(np.int64).tolist(), (first + at).tolist(), size.tolist(), strict=True)
    return out


def send_contexts(kind: str):
    def run(batches):
        for batch in batches:
            rows, anchors, hashes, starts, sizes = [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                if len(raw) < LENGTH:
                    continue
                view = memoryview(raw)
                for anchor, start, size in contexts(raw):
                    rows.append(row)
                    anchors.append(anchor)
                    starts.append(start)
                    sizes.append(size)
                    hashes.append(xxhash.xxh3_64_intdigest(view[start:start + size]) - (1 << 63))
            yield pa.RecordBatch.from_arrays([
                pa.array(anchors, pa.int64()), pa.array(hashes, pa.int64()), batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
            ], names=["anchor", "context", "key", "start", "size"])

    return run, f"anchor long, context long, key {kind}, start long, size long"


# Suffix order and factors


def suffix_ranks(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the ``valid`` places that share their first ``LENGTH`` bytes with another, and their ranks.

    Prefix doubling from eight bytes on; places that are alone with a prefix have their
    final rank and are left out of the rounds that follow.
    """
    n = len(data)
    word = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    for step in (1, 2, 4):
        word = word[:-step] << np.uint64(8 * step) | word[step:]
    order = np.argsort(word[:n], kind="stable")
    ordered = word[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(n + LENGTH, np.int64)
    rank[n:] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    active = order[~(new & np.append(new[1:], True))]
    length = 8
    while length < LENGTH and len(active):
        grown = min(2 * length, LENGTH)
        first, second = rank[active], rank[active + grown - length]
        by = np.lexsort((second, first))
        active, first, second = active[by], first[by], second[by]
        group = np.concatenate(([True], first[1:] != first[:-1]))
        part = group | np.concatenate(([True], second[1:] != second[:-1]))
        place = np.arange(len(active))
        start_of = lambda flags: np.maximum.accumulate(np.where(flags, place, 0))
        rank[active] = first + start_of(part) - start_of(group)
        active = active[~(part & np.append(part[1:], True))]
        length = grown
    active = active[valid[active]]
    by = np.lexsort((active, rank[active]))
    return active[by], rank[active[by]]


def nearest_smaller(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each entry of a suffix order, the bytes it shares with the nearest entry before it of smaller position.

    ``common`` holds the bytes shared with the entry just before. All entries jump over
    larger ones at once, along the jumps these have made.
    """
    n = len(position)
    before, least = np.arange(-1, n - 1), common.copy()
    moving = np.flatnonzero((before >= 0) & (position[np.maximum(before, 0)] > position))
    while len(moving):
        over = before[moving]
        least[moving] = np.minimum(least[moving], least[over])
        before[moving] = before[over]
        at = before[moving]
        moving = moving[(at >= 0) & (position[np.maximum(at, 0)] > position[moving])]
    least[before < 0] = 0
    return least


def factors(order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Longest previous factor of each entry, up to ``LENGTH``: the better of its nearest smaller neighbours on both sides."""
    common = np.concatenate(([0], np.where(rank[1:] == rank[:-1], LENGTH, 0)))
    before = nearest_smaller(order, common)
    after = nearest_smaller(order[::-1], np.concatenate(([0], common[:0:-1])))[::-1]
    return np.maximum(before, after)


def repeated_windows(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the repeated windows in the joined pieces, and whether each has an earlier copy; also the pieces' starts."""
    starts = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(data))
    order, rank = suffix_ranks(data, left >= LENGTH)
    if not len(order):
        return order, np.empty(0, bool), starts
    earlier = factors(order, rank) >= LENGTH
    later = factors(-order, rank) >= LENGTH
    some = earlier | later
    by = np.argsort(order[some])
    return order[some][by], earlier[some][by], starts


def runs(places: np.ndarray) -> list[tuple[int, int]]:
    """Bytes covered by windows at these sorted places, as merged ranges."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > LENGTH) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(places)])) - 1
    return list(zip(places[first].tolist(), (places[last] + LENGTH).tolist(), strict=True))


RANGES = "anchor long, context long, low long, high long, later boolean"


def match_contexts(batches):
    """Rows (anchor, context, bytes) sorted by anchor, then first place; ranges that repeat, and those with an earlier copy."""
    rows, size, last, seen = [], 0, None, set()

    def flush():
        out = {"anchor": [], "context": [], "low": [], "high": [], "later": []}
        places, earlier, starts = repeated_windows([r[2] for r in rows])
        for i, (anchor, context, _) in enumerate(rows):
            a, b = np.searchsorted(places, (starts[i], starts[i + 1]))
            own, back = places[a:b] - starts[i], earlier[a:b]
            for later, ranges in ((False, runs(own)), (True, runs(own[back]))):
                for low, high in ranges:
                    for name, value in zip(out, (anchor, context, low, high, later), strict=True):
                        out[name].append(value)
        return pa.RecordBatch.from_arrays([
            *(pa.array(out[name], pa.int64()) for name in ("anchor", "context", "low", "high")), pa.array(out["later"], pa.bool_()),
        ], names=list(out))

    for batch in batches:
        for anchor, context, piece in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if anchor != last:
                seen.clear()
                if size >= ARRAY_BYTES:
                    yield flush()
                    rows, size = [], 0
            elif context in seen:
                continue  # a repeated row
            seen.add(context)
            rows.append((anchor, context, piece))
            size += len(piece)
            last = anchor
    if rows:
        yield flush()


BLOCK_ROWS = "anchor long, context long, key {kind}, start long, block long, core long, whole long, low long, high long, piece binary"


def send_blocks(batches):
    """Rows (anchor, context, bytes, key, start) as blocks of windows of like distance to the anchor.

    All windows of a block hold its core; ``whole`` is all that the block's own windows cover. The bytes of
    the latter go along.
    """
    for batch in batches:
        out = {name: [] for name in ("anchor", "context", "key", "start", "block", "core", "whole", "low", "high", "piece")}
        for key, (anchor, context, piece, start) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True)):
            last = len(piece) - LENGTH
            at = int(rightmost_smallest(gram_hashes(np.frombuffer(piece[:LENGTH], np.uint8)), LENGTH - GRAM + 1)[0])
            for block in range(max(0, at - last) // BLOCK, at // BLOCK + 1):
                highest = at - BLOCK * block
                low, high = max(0, highest - BLOCK + 1), min(last, highest)
                core = piece[highest:highest - BLOCK + 1 + LENGTH]
                own = piece[low:high + LENGTH]
                for name, value in zip(out, (
                    anchor, context, key, start, block, xxhash.xxh3_64_intdigest(core) - (1 << 63),
                    xxhash.xxh3_64_intdigest(own, seed=at - low) - (1 << 63), low, high, own,
                ), strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_arrays([
            batch.column(3).take(pa.array(v, pa.int64())) if name == "key" else pa.array(v, pa.binary() if name == "piece" else pa.int64())
            for name, v in out.items()
        ], names=list(out))


def send_windows(batches):
    """Block rows (anchor, context, key, start, low, bytes) as single windows, with a hash of each."""
    for batch in batches:
        out = {name: [] for name in ("anchor", "context", "key", "start", "place", "window")}
        for key, (anchor, context, start, low, piece) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)), strict=True)):
            view = memoryview(piece)
            for i in range(len(piece) - LENGTH + 1):
                for name, value in zip(out, (anchor, context, key, start, low + i, xxhash.xxh3_64_intdigest(view[i:i + LENGTH]) - (1 << 63)), strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_arrays([
            batch.column(2).take(pa.array(v, pa.int64())) if name == "key" else pa.array(v, pa.int64()) for name, v in out.items()
        ], names=list(out))


def split_ranges(many: DataFrame, kind: str, keep_first: bool) -> DataFrame:
    """(anchor, context, low, high) of contexts whose anchor has very many different ones, without holding an anchor whole.

    Blocks that are equal as a whole are counted; only where blocks share their core but
    differ around it are single windows counted, with one block for each whole.
    """
    blocks = many.select("anchor", "context", "piece", "key", "start").mapInArrow(send_blocks, BLOCK_ROWS.format(kind=kind))
    core, whole = ["anchor", "block", "core"], ["anchor", "block", "core", "whole"]
    counted = stored(blocks.withColumns({
        "n_core": F.count("*").over(Window.partitionBy(*core)), "n_whole": F.count("*").over(Window.partitionBy(*whole)),
        "copy": F.row_number().over(Window.partitionBy(*whole).orderBy("key", "start")),
    }).where("n_core > 1"), "blocks")
    equal = counted.where("copy > 1" if keep_first else "n_whole > 1").select(
        "anchor", "context", "low", (F.col("high") + LENGTH).alias("high")
    )
    windows = counted.where("copy = 1 and n_core > n_whole").select("anchor", "context", "key", "start", "low", "piece").mapInArrow(
        send_windows, f"anchor long, context long, key {kind}, start long, place long, window long"
    )
    same = Window.partitionBy("anchor", "window")
    found = windows.select(
        "anchor", "context", "place", F.count("*").over(same).alias("n"),
        F.row_number().over(same.orderBy("key", "start", "place")).alias("copy"),
    ).where("copy > 1" if keep_first else "n > 1")
    return equal.unionByName(found.select("anchor", "context", F.col("place").alias("low"), (F.col("place") + LENGTH).alias("high")))


def repeated_ranges(docs: DataFrame, kind: str, keep_first: bool) -> DataFrame:
    """(key, low, high): byte ranges to remove from a ``keyed`` frame's texts."""
    run, schema = send_contexts(kind)
    sent = stored(docs.mapInArrow(run, schema), "contexts")
    counted = sent.groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "start", "size")).alias("first")
    )
    by_anchor = Window.partitionBy("anchor")
    groups = stored(
        counted.withColumn("different", F.count("*").over(by_anchor)).where("n > 1 or different > 1"), "context-groups"
    )
    mixed_groups = groups.where("different > 1").select(
        F.col("first.key").alias("key"), F.struct("anchor", "context", "first.start", "first.size", "different").alias("at")
    )
    wanted = mixed_groups.groupBy("key").agg(F.collect_list("at").alias("wanted"))
    cut = _cut(wanted, docs)
    pieces = stored(cut, "context-bytes")
    few = pieces.where(f"different <= {SPLIT}").repartition("anchor").sortWithinPartitions("anchor", "key", "start").select(
        "anchor", "context", "piece"
    ).mapInArrow(match_contexts, RANGES)
    many = pieces.where(f"different > {SPLIT}").dropDuplicates(["anchor", "context"])
    split = split_ranges(many, kind, keep_first)
    ranges = few.where("later" if keep_first else "not later").drop("later").unionByName(split)
    # What holds for a context holds for each of its occurrences.
    whole = groups.where("n > 1").select("anchor", "context", F.col("first.key").alias("k"), F.col("first.start").alias("s"))
    copies = sent.join(whole, ["anchor", "context"]).where("not (key = k and start = s)" if keep_first else "true").select(
        "key", F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high")
    )
    single = groups.where("different > 1" if keep_first else "different > 1 and n = 1").select("anchor", "context", "first")
    parts = ranges.join(single, ["anchor", "context"]).select(
        F.col("first.key").alias("key"), (F.col("first.start") + F.col("low")).alias("low"),
        (F.col("first.start") + F.col("high")).alias("high"),
    )
    return copies.unionByName(parts)


def _cut(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of the wanted contexts."""
    kind = wanted.schema["key"].dataType.simpleString()
    both = wanted.select(F.col("key").alias("k"), "wanted").join(docs, F.col("k") == F.col("key")).select("key", "text", "wanted")

    def run(batches):
        for batch in batches:
            rows = {"anchor": [], "context": [], "key": [], "start": [], "different": [], "piece": []}
            size = 0
            for key, text, at in zip(*(batch.column(i) for i in range(3)), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                for one in at.as_py():
                    piece = raw[one["start"]:one["start"] + one["size"]]
                    if xxhash.xxh3_64_intdigest(piece) - (1 << 63) != one["context"]:
                        continue  # another text with the same key, hash and size
                    for name in ("anchor", "context", "start", "different"):
                        rows[name].append(one[name])
                    rows["key"].append(key.as_py())
                    rows["piece"].append(piece)
                    size += len(piece)
                if size > 8 << 20:
                    yield _pieces(rows, batch.schema.field(0).type)
                    rows, size = {name: [] for name in rows}, 0
            yield _pieces(rows, batch.schema.field(0).type)

    return both.mapInArrow(
        run, f"anchor long, context long, key {kind}, start long, different long, piece binary"
    )


def _pieces(rows: dict, kind: pa.DataType) -> pa.RecordBatch:
    types = {"key": kind, "piece": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in rows.items()], names=list(rows))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def told_apart(rows: DataFrame) -> DataFrame:
    """A ``keyed`` frame whose key also holds a hash and the size of the text, so texts with one id, or none, do not mix."""
    return rows.select(
        F.struct(F.col("key").alias("id"), F.xxhash64("text").alias("code"), F.octet_length("text").alias("size")).alias("key"), "text"
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_first: bool = True) -> DataFrame:
    """Per row: key, bytes, bytes removed, maximal removed runs as ranges, and the bytes kept."""
    kind = dict(docs.dtypes)[key]
    rows = told_apart(keyed(docs, key, text))
    ranges = repeated_ranges(rows, dict(rows.dtypes)["key"], keep_first).groupBy("key").agg(
        F.collect_set(F.struct("low", "high")).alias("ranges")
    ).select(F.col("key").alias("k"), "ranges")
    both = rows.join(ranges, F.col("key") == F.col("k"), "left").select("key.id", "text", "ranges")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes, removed, spans, kept = [], [], [], []
                for value, given in zip(part.column(1), part.column(2), strict=True):
                    raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                    gone = merged([(r["low"], r["high"]) for r in given.as_py() or [] if r["high"] <= len(raw)])
                    edges = [0, *(x for pair in gone for x in pair), len(raw)]
                    sizes.append(len(raw))
                    removed.append(sum(b - a for a, b in gone))
                    spans.append([{"low": a, "high": b} for a, b in gone])
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), pa.array(kept, pa.binary()),
                ], names=["key", "n_bytes", "n_removed", "spans", "kept"])

    schema = f"key {kind}, n_bytes long, n_removed long, spans array<struct<low: long, high: long>>, kept binary"
    return both.mapInArrow(run, schema).withColumnRenamed("key", key)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, keep_first=False).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
