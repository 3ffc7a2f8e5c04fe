"""Exact Jaccard self-join of documents on word shingles, by partitions of the token universe.

A document is the set of its distinct five-word shingles; two documents link when
their sets' Jaccard similarity is at least ``PERCENT``. Equal sets are one class. Classes are
banded by size; a pair meets in the band of the smaller set. In a band all shingles are
hashed to segments. Linked sets of sizes r and s differ in at most (r + s) / 7 shingles, so they agree
on segments that together hold more than that many units: a segment of one shingle is worth
one unit, matched by the same subset; with one-deletion neighbourhoods a segment of two or
more is worth two, matched also when one shingle is missing on either side. How many
segments a band has, and whether it uses deletions, is allocated by expected cost.

Signatures that only one class has are dropped, and so are classes whose remaining
signatures could not make up a link. Units to spare are allocated to a class's most frequent
signatures, which are left out, as a passage that many documents share makes them costly. A signature that
still has over ``BUSY`` classes is not used: its classes are allocated anew, with segments of one shingle each, so
that all but the bound's share of them can be spared, the most frequent ones. What is left are a
class's rarest shingles with their places; two classes meet only if, from the places of a shingle that both have,
enough shingles can follow for a link. Documents that share a passage and little else have their own
shingles before it and never meet, so such a passage costs no pairs.

Classes that share a signature are first compared with the first of them, and later only across components, so that a
group of n copies costs about n comparisons. Every link is verified on the texts.

Defined cases: a text without words has an empty set and links with nothing; one with
fewer than five words is one shingle; case matters for other letters than A to Z; rows are linked by their texts
alone, so neither null ids nor ids repeated with other texts hide a link; a component is named by the smallest
id in it, and has a null name if all its rows lack an id.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from kerbside.llm.graphs import components, narrow_files, relabelled, small_or_not, stored, wide_files
from kerbside.llm.texts import ASCII_SPACE, Hashes, blocks, keyed, mixed, offsets, runs_hashed, tables_of

WORDS = 5
PERCENT = 75
#: A band's allocation must leave fewer than this share of its sets short of units; those go the long way.
SHORT_SHARE = 1e-9
#: Classes of a signature up to which it is used as it is.
BUSY = 16
#: Text bytes whose signatures are made at once; their arrays take some sixty times as much memory.
SENT_BYTES = 1 << 20
#: Bytes of a word above which it is hashed by itself.
LONG_WORD = 64
#: By a byte's value, whether it parts words; by a number of bytes up to eight, a mask that holds so many.
SPACES = np.isin(np.arange(256), list(ASCII_SPACE.encode()))
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Classes remembered in a task, whose signatures it has sent already.
SEEN = 200_000


def word_codes(texts: list[bytes], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of these texts, and each text's first word and the one behind its last.

    Words are hashed all at once, eight bytes in a step; those of over ``LONG_WORD`` bytes one by one.
    """
    joined = b" " + b" ".join(texts) + b" " * 8
    gap = SPACES[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    first, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(joined) - 7, "<u8", joined, strides=(1,))  # the bytes from each place on
    codes = mixed((eight[first] & FIRST_BYTES[np.minimum(size, 8)]) ^ mixed(size))
    at = np.flatnonzero(size > 8)
    for step in range(8, LONG_WORD, 8):
        codes[at] = mixed(codes[at] + (eight[first[at] + step] & FIRST_BYTES[np.minimum(size[at] - step, 8)]))
        at = at[size[at] > step + 8]
    for i in at:
        codes[i] = hashes[joined[first[i]:first[i] + size[i]]]
    return codes, np.searchsorted(first, offsets([len(t) + 1 for t in texts]))


def shingle_sets(texts: list[bytes], hashes: Hashes) -> list[np.ndarray]:
    """Distinct shingles of each text as sorted 64-bit hashes."""
    codes, bounds = word_codes([t.lower() for t in texts], hashes)
    runs, out = runs_hashed(codes, WORDS), []
    for low, high in pairwise(bounds.tolist()):
        if high - low < WORDS:
            out.append(runs_hashed(codes[low:high], high - low) if high > low else np.empty(0, np.uint64))
        else:
            found = np.sort(runs[low:high - WORDS + 1])
            out.append(found[np.append(True, found[1:] != found[:-1])])
    return out


def shingles(words: list[bytes], hashes: Hashes) -> np.ndarray:
    """Distinct shingles of one text's words."""
    return shingle_sets([b" ".join(words)], hashes)[0]


def word_list(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


# Bands and their allocation


def largest_partner(size: int) -> int:
    return 100 * size // PERCENT


def most_different(r: int, s: int) -> int:
    """Elements in just one of two linked sets of these sizes, at most."""
    return (r + s) * (100 - PERCENT) // (100 + PERCENT)


@lru_cache(maxsize=1)
def band_starts() -> np.ndarray:
    """First size of each band; linked sets are in the same band or in neighbouring ones."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(largest_partner(starts[-1]) + 1)
    return np.array(starts, np.int64)


@dataclass(frozen=True)
class Allocation:
    segments: int
    deletions: bool


@lru_cache(maxsize=None)
def allocation(band: int) -> Allocation:
    """The cheapest number of segments and kind of signature for a band.

    The cost of a set is its expected number of signatures, those of single shingles
    counted double as they meet more sets. Units are taken as normal with the variance of
    independent segments, which is above the true one.
    """
    low, high = (int(x) for x in band_starts()[band:band + 2])
    high -= 1
    best = None
    for deletions in (False, True):
        for load in (0.02, 0.1, 0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 1.75, 2.0, 2.25, 2.5, 3.0, 3.5, 4.0):
            m = max(1, math.ceil(high / load))
            cost, sound = 0.0, True
            for size in {low, (low + high) // 2, high}:
                x = size / m
                none, one = math.exp(-x), x * math.exp(-x)
                more = 1 - none - one
                worth = 2 if deletions else 1
                mean, square = one + worth * more, one + worth * worth * more
                need = most_different(size, largest_partner(size)) + 1
                spread = math.sqrt(max(m * (square - mean * mean) - size * x / max(size, 1) * (one + none) ** 2, 1e-9))
                short = 0.5 * math.erfc((m * mean - need + 0.5) / spread / math.sqrt(2))
                if size <= need or size < 40 and m < 1500:
                    short = 1.0 if size > 1 or m > 1 else 0.0
                sound &= short <= SHORT_SHARE or m == 1 and high == 1
                cost += m * (2 * one + more) + (m * more * 3 if deletions else 0)
            if sound and (best is None or cost < best[0]):
                best = (cost, Allocation(m, deletions))
    return best[1] if best else Allocation(max(1500, 4 * high), False)


def signatures(sets: list[np.ndarray], band: np.ndarray, partner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, the set of each, and per set how many must be shared for a link (below one: too few units).

    ``partner`` is the largest size that a linked set in this band's join can have.
    """
    size = np.array([len(s) for s in sets])
    kinds = [allocation(int(b)) for b in band]
    m = np.array([k.segments for k in kinds], np.int64)
    deletes = np.array([k.deletions for k in kinds])
    base = np.concatenate(([0], np.cumsum(m)))
    owner = np.repeat(np.arange(len(sets)), size)
    token = np.concatenate(sets)
    salt = mixed(band.astype(np.uint64) + np.uint64(77))[owner]
    spot = ((mixed(token ^ salt) >> np.uint64(32)) * m[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    place = base[owner] + spot
    value = mixed(token + salt)
    total = np.zeros(base[-1], np.uint64)
    np.add.at(total, place, value)
    count = np.bincount(place, minlength=base[-1])
    held = np.flatnonzero(count)
    set_of = np.searchsorted(base, held, "right") - 1
    mark = lambda at, own: mixed((at - base[own]).astype(np.uint64) * np.uint64(64) + band[own].astype(np.uint64))
    out, of = [mixed(total[held] ^ mark(held, set_of))], [set_of]
    less = np.flatnonzero(deletes[owner] & (count[place] >= 2))
    if len(less):
        out.append(mixed((total[place[less]] - value[less]) ^ mark(place[less], owner[less])))
        of.append(owner[less])
    units = np.bincount(set_of, np.where(deletes[set_of] & (count[held] >= 2), 2, 1), len(sets)).astype(np.int64)
    spare = units - (size + partner) * (100 - PERCENT) // (100 + PERCENT)
    # A segment worth two units shows as one signature at least.
    needed = np.where(spare < 1, 0, np.where(deletes, (spare + 1) // 2, spare))
    return np.concatenate(out), np.concatenate(of), needed


def sender(key: pa.DataType):
    """Task function over ``keyed`` rows: a row for each text with its set's size and digests, and the signatures of each class.

    Signatures of a class are sent once a task. How many of them a link needs is negative for those of the band below. A class
    short of units gets a row without signature. Rows of texts have a signature that no other row has, so that they spread.
    """
    shape = pa.schema([("sig", pa.int64()), ("cls", pa.int64()), ("needed", pa.int32()), ("key", key), ("digests", pa.binary())])

    def rows_of(sig, cls, needed) -> pa.RecordBatch:
        n = len(cls)
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int64()) if sig is None else pa.array(sig.view(np.int64)), pa.array(cls),
            pa.array(needed.astype(np.int32)), pa.nulls(n, key), pa.nulls(n, pa.binary()),
        ], schema=shape)

    def texts_rows(keys, texts, sets, classes) -> pa.RecordBatch:
        names = [hashlib.md5(t).digest() for t in texts]
        spread = np.array([xxhash.xxh3_64_intdigest(n + i.to_bytes(8, "little")) for i, n in enumerate(names)], np.uint64)
        return pa.RecordBatch.from_arrays([
            pa.array(spread.view(np.int64)), pa.array(np.array(classes, np.uint64).view(np.int64)),
            pa.array([len(s) for s in sets], pa.int32()), keys.cast(key),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) + n for s, n in zip(sets, names, strict=True)], pa.binary()),
        ], schema=shape)

    def run(batches):
        tables_of("jaccard_join")
        hashes, seen = Hashes(), set()
        for keys, texts in blocks(batches, SENT_BYTES):
            texts = [t.encode("utf-8", "surrogatepass") for t in texts]
            every = shingle_sets(texts, hashes)
            digests = [xxhash.xxh3_64_intdigest(s.tobytes()) for s in every]
            yield texts_rows(keys, texts, every, digests)
            sets, classes = [], []
            for s, cls in zip(every, digests, strict=True):
                if len(s) and cls not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(cls)
                    sets.append(s)
                    classes.append(cls)
            if not sets:
                continue
            cls = np.array(classes, np.uint64).view(np.int64)
            size = np.array([len(s) for s in sets])
            band = np.searchsorted(band_starts(), size, "right") - 1
            below = band_starts()[band] - 1  # the largest size of the band below
            down = np.flatnonzero((band > 0) & (below * 100 >= size * PERCENT))
            for pick, at, partner, sign in (
                (np.arange(len(sets)), band, size * 100 // PERCENT, 1), (down, band[down] - 1, below[down], -1),
            ):
                if not len(pick):
                    continue
                sig, of, needed = signatures([sets[i] for i in pick], at, partner)
                full = needed[of] > 0
                short = np.flatnonzero(needed == 0)
                for a in range(0, max(1, len(of)), 1 << 18):
                    part = slice(a, a + (1 << 18))
                    keep = full[part]
                    yield rows_of(sig[part][keep], cls[pick[of[part][keep]]], needed[of[part][keep]] * sign)
                if len(short):
                    yield rows_of(None, cls[pick[short]], np.zeros(len(short), np.int32))

    return run


def text_name(text: Column) -> Column:
    """Digest that stands for a text; a null text is empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


@dataclass(frozen=True)
class Files:
    """Most files of a stored table, by what it holds of each document."""

    narrow: int
    wide: int

    @classmethod
    def by(cls, docs: DataFrame) -> Files:
        many = docs.count()
        return cls(narrow_files(many), wide_files(docs.sparkSession, many))


def sets_of(rows: DataFrame, names: DataFrame, files: Files) -> DataFrame:
    """(name, shingles) for the texts of these ``names``; the shingles are sorted hashes, eight bytes each."""
    named = rows.select(text_name(F.col("text")).alias("name"), "text").join(small_or_not(names), "name").dropDuplicates(["name"])

    def work(batches):
        hashes = Hashes()
        for keys, texts in blocks(batches):
            found = [s.tobytes() for s in shingle_sets([t.encode("utf-8", "surrogatepass") for t in texts], hashes)]
            yield pa.RecordBatch.from_arrays([keys.cast(pa.binary()), pa.array(found, pa.binary())], names=["name", "shingles"])

    return stored(named.select("name", "text").mapInArrow(work, "name binary, shingles binary"), "linked-sets", files.wide)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    one = sets.select(F.col("name").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("name").alias("b"), F.col("shingles").alias("set_b"))
    kind = pairs.schema["a"].dataType.simpleString()

    def check(batches):
        for batch in batches:
            left, right = ([np.frombuffer(s.as_py(), np.uint64) for s in batch.column(k)] for k in (2, 3))
            keep = [i for i, (x, y) in enumerate(zip(left, right, strict=True)) if linked(x, y)]
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b").mapInArrow(check, f"a {kind}, b {kind}")


def link_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_shingles and component_id, the smallest key reachable by links."""
    rows, files = keyed(docs, key, text), Files.by(docs)
    shared = shared_signatures(rows, files)
    sets = stored(shared.where("digests is not null").select(
        "key", F.col("needed").cast("long").alias("n_shingles"), "cls",
        F.substring("digests", 1, 16).alias("whole"), F.substring("digests", 17, 16).alias("name"),
    ), "shingle-sets", files.wide)
    # A class goes by one of its texts.
    classes = stored(
        sets.where("n_shingles > 0").groupBy("whole").agg(
            F.min("name").alias("rep"), F.first("n_shingles").alias("size"), F.first("cls").alias("cls"), F.min("key").alias("least")
        ), "classes", files.narrow,
    )
    labels = _linked_classes(rows, classes, *candidates(rows, shared.where("digests is null").drop("key", "digests"), classes), files)
    found = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "whole", "least", F.coalesce("component", "rep").alias("component")
    )
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    names = found.join(least, "component").select("whole", "component_id")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key"))
    return sets.join(names, "whole", "left").select(F.col("key").alias(key), "n_shingles", own.alias("component_id"))


def shared_signatures(rows: DataFrame, files: Files) -> DataFrame:
    """The rows of texts, and of all signatures those that several classes have, with how often they occur."""
    sent = rows.mapInArrow(
        sender(to_arrow_schema(rows.select("key").schema).field(0).type),
        f"sig long, cls long, needed int, key {rows.schema['key'].dataType.simpleString()}, digests binary")
    by_sig = Window.partitionBy("sig")
    several = F.min("cls").over(by_sig) != F.max("cls").over(by_sig)
    marked = sent.withColumns({"several": several, "often": F.count("cls").over(by_sig)})
    return stored(marked.where("several or sig is null or digests is not null").drop("several"), "shared-signatures", files.wide)


def candidates(rows: DataFrame, shared: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sig, rep, size, at, place) of classes that share signatures enough to link; and classes short of units."""
    by_sig, files = Window.partitionBy("sig"), Files.by(classes)
    short = shared.where("sig is null").select("cls").distinct()
    # A link of a class needs ``needed`` of its signatures here, so the most frequent ones but these can be spared.
    of_class = Window.partitionBy("cls", "own")
    ranked = shared.where("sig is not null").select(
        "sig", "cls", "often", F.abs("needed").alias("needed"), (F.col("needed") > 0).alias("own")
    ).repartition("cls", "own").distinct().withColumns({
        "n": F.count("*").over(of_class), "rank": F.row_number().over(of_class.orderBy(F.desc("often"), "sig")),
    })
    kept = ranked.where("n >= needed and rank >= needed").select("sig", "cls").join(classes.select("cls", "rep", "size"), "cls")
    counted = stored(kept.select("sig", "rep", "size").withColumn("n", F.count("*").over(by_sig)).where("n > 1"), "members", files.wide)
    few = counted.where(f"n <= {BUSY}").select("sig", "rep", "size", F.lit(1).cast("long").alias("at"))
    busy = stored(counted.where(f"n > {BUSY}").select("rep", "size").distinct(), "busy", files.narrow)
    if not busy.isEmpty():
        few = few.unionByName(rarest_shingles(rows, busy, files))
    members = stored(few.withColumn("place", F.row_number().over(by_sig.orderBy("rep"))), "placed", files.wide)
    return members, short.join(classes, "cls").select("rep", "size")


def rarest_shingles(rows: DataFrame, busy: DataFrame, files: Files) -> DataFrame:
    """(sig, rep, size, at) of the shingles that a link of these classes with each other must show one of.

    ``at`` is a shingle's place among those of its class, by rising frequency in these classes. Two sets that
    overlap in n shingles have their first common one n places before the end at the latest.
    """

    def send(batches):
        for batch in batches:
            for name, held in zip(batch.column(0), batch.column(1), strict=True):
                found = np.frombuffer(held.as_py(), np.uint64)
                for a in range(0, len(found), 1 << 18):
                    part = found[a:a + (1 << 18)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part.view(np.int64)), pa.array([name.as_py()] * len(part), pa.binary())], names=["sig", "rep"])

    sets = sets_of(rows, busy.select(F.col("rep").alias("name")), files)
    sent = stored(sets.mapInArrow(send, "sig long, rep binary"), "busy-shingles", files.wide)
    often = sent.groupBy("sig").agg(F.count("*").alias("often")).where("often > 1")
    order = Window.partitionBy("rep").orderBy(F.coalesce("often", F.lit(1)), "sig")
    placed = sent.join(often, "sig", "left").withColumn("at", F.row_number().over(order).cast("long")).where("often is not null")
    return placed.join(busy, "rep").where(f"100 * (size - at + 1) >= {PERCENT} * size").select("sig", "rep", "size", "at")


def meets(a: str, b: str) -> str:
    """Whether two classes that share a signature at these places can link at all."""
    enough = [f"{100 + PERCENT} * (size_{x} - at_{x} + 1) >= {PERCENT} * (size_a + size_b)" for x in (a, b)]
    return " and ".join([*enough, f"100 * least(size_a, size_b) >= {PERCENT} * greatest(size_a, size_b)"])


def side(members: DataFrame, x: str, *more: Column) -> DataFrame:
    return members.select("sig", *[F.col(c).alias(n) for c, n in (("rep", x), ("size", f"size_{x}"), ("at", f"at_{x}"))], *more)


def _short_pairs(short: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes short of units against all classes of a like size; expected to be none."""
    starts = F.array(*[F.lit(int(x)) for x in band_starts()])
    band = lambda size: F.size(F.filter(starts, lambda x: x <= size))
    near = short.withColumn("band", F.explode(F.array(*[band(F.col("size")) + d for d in (-1, 0, 1)]))).select(
        F.col("rep").alias("a"), F.col("size").alias("size_a"), "band"
    )
    every = classes.select(F.col("rep").alias("b"), F.col("size").alias("size_b"), band(F.col("size")).alias("band"))
    return near.join(every, "band").where(
        f"a != b and 100 * least(size_a, size_b) >= {PERCENT} * greatest(size_a, size_b)"
    ).select("a", "b")


def _linked_classes(rows: DataFrame, classes: DataFrame, members: DataFrame, short: DataFrame, files: Files) -> DataFrame:
    """(node, component) of the classes that link with another."""
    short = stored(short, "short", files.narrow)
    long_way = not short.isEmpty()
    involved = members.select(F.col("rep").alias("name"))
    pairs = side(members.where("place = 1"), "a").join(side(members.where("place > 1"), "b"), "sig").where(meets("a", "b")).select("a", "b")
    if long_way:
        far = _short_pairs(short, classes)
        pairs = pairs.unionAll(far)
        involved = involved.unionAll(far.select("a")).unionAll(far.select("b"))
    sets = sets_of(rows, stored(involved.distinct(), "involved", files.narrow), files)
    tested = stored(pairs.distinct(), "pairs", files.wide)
    labels = components(verified(tested, sets), files.narrow)
    first, last, open_ = 2, 5, members
    while True:
        known = open_.drop("component").join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep")
        )
        by_sig = Window.partitionBy("sig")
        open_ = stored(
            known.withColumn("several", F.min("component").over(by_sig) != F.max("component").over(by_sig)).withColumn(
                "size_of", F.max("place").over(by_sig)
            ).where(f"several and size_of > {first}").drop("several", "size_of"), "open", files.wide,
        )
        if open_.isEmpty():
            return labels
        pivots = side(open_.where(f"place between {first} and {last}"), "a", F.col("component").alias("from"), F.col("place").alias("before"))
        others = side(open_, "b", F.col("component"), F.col("place"))
        pairs = pivots.join(others, "sig").where(f"place > before and `from` != component and {meets('a', 'b')}").select("a", "b").distinct()
        new = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs", files.wide)
        links = verified(new, sets)
        lift = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"root_{side}"))
        roots = links.join(lift("a"), "a", "left").join(lift("b"), "b", "left").select(
            F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")
        )
        merged = components(roots, files.narrow).select("node", F.col("component").alias("root"))
        labels = stored(
            relabelled(labels.select("node", F.col("component").alias("root")), merged).unionByName(
                merged.join(labels.select("node"), "node", "left_anti")
            ).select("node", F.col("root").alias("component")), "labels", files.narrow,
        )
        tested = tested.unionAll(new)
        first, last = last + 1, last + 8 * (last - first + 1)


def digest(docs: DataFrame) -> DataFrame:
    return link_components(docs)
