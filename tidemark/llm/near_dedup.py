"""SimHash near-duplicates by pigeonring filtering.

Whole texts get a 64-bit SimHash of their word shingles. The 64 bits are cut into ``segments`` on a ring. If two
fingerprints differ in at most ``bits`` bits, the pigeonring principle gives a start segment from which EVERY chain of
l consecutive segments differs in at most ``l * bits / segments`` bits. With 5 segments and 4 bits that start segment
is equal (budget 0.8) and its successor differs in at most one bit (budget 1.6), so both together, 26 bits, are the
join key: a fingerprint goes to its own key and, when the second segment has odd parity, also to the keys one bit
away (two segments one bit apart have different parity, so one side suffices). Within a key the longer chains are
tested first, then the full Hamming distance.

Pairs are never listed: each key's members give a spanning forest of their links, which has the same components.

Four bits of 64 find copies that differ in a few words of a long text; copies of five-word similarity 0.8 differ in about
ten bits, out of reach of any selective key. :func:`keep_one_each`, which must catch those too, therefore also links texts
by the exact Jaccard similarity of their shingle sets. One-permutation minhash signatures only find candidates: equal bands
are keys, and in a key members whose signatures agree in clearly fewer places than wanted are candidates. Every link lies
inside a component of candidates, so each component's shingle hashes meet once and their exact links give a forest.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stable

from .common import components, whole_text

SHINGLES_AT_ONCE = 1 << 16


def _word_shingles(text: str, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of one text, in blocks."""
    words = text.encode().lower().split()  # bytes: lower-cases A-Z alone, splits at \\x20 and \\x09-\\x0D
    if not words:
        return
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        yield np.array([digest(line, seed)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    ends = (ends[width - 1:] - 1).tolist()
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = zip(starts[at:at + SHINGLES_AT_ONCE], ends[at:at + SHINGLES_AT_ONCE], strict=True)
        yield np.fromiter([digest(line[i:j], seed) for i, j in part], np.uint64)


def simhash(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Signed 64-bit SimHash; a bit is set if it is set in over half the shingle hashes; no words: 0."""
    total, ones = 0, np.zeros(64, np.int64)
    for block in _word_shingles(text or "", width, seed):
        total += len(block)
        ones += np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0]) if total else 0


def simhash_column(text: str = "text", width: int = 4, seed: int = 42):
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, width, seed) for x in texts], dtype="int64")

    return run(whole_text(text))


BINS, BANDS, BAND_ROWS = 96, 16, 5
LIKELY = 0.2  # a candidate's signature agrees in the wanted similarity less this: five standard errors at 0.8
MORE = 3  # see _short_tree
SHORT_BLOCKS = 4  # a block has so many times as many short texts, which are compared with few others
FEW = 400  # pairs with fewer shingles together are candidates by their band alone: their places are not independent
_ODD = (np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)  # fixed multipliers, one a place

#: The smallest hash of each bin; bins cut the upper 32 bits evenly.
_EDGES = np.array([-(-(i << 32) // BINS) << 32 for i in range(BINS)], np.uint64)


def _once(blocks: list[np.ndarray]) -> np.ndarray:
    """The different hashes, in order."""
    hashes = np.sort(np.concatenate([*blocks, np.zeros(0, np.uint64)]))
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))] if len(hashes) else hashes


def signature(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """One-permutation minhash: the smallest hash of each of the bins; an empty bin borrows from the next one. None without shingles."""
    least, some = np.full(BINS, np.iinfo(np.uint64).max, np.uint64), np.zeros(BINS, bool)
    for block in blocks:
        ordered = np.sort(block)
        first = np.append(np.searchsorted(ordered, _EDGES), len(ordered))
        own = first[:-1] < first[1:]
        least[own] = np.minimum(least[own], ordered[first[:-1][own]])
        some |= own
    full = np.flatnonzero(some)
    if not len(full):
        return None
    lender = full[np.searchsorted(full, np.arange(BINS)) % len(full)]
    return least[lender] + ((lender - np.arange(BINS)) % BINS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _marks(text: str | None, width: int, seed: int) -> tuple[int, int, list[int], bytes, bytes]:
    """(SimHash, node, band keys, one byte of each signature place, the different shingle hashes); equal shingle sets give equal nodes."""
    total, ones, blocks = 0, np.zeros(64, np.int64), []
    for block in _word_shingles(text or "", width, seed):
        total += len(block)
        ones += np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        blocks.append(block)
    fp = int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0]) if total else 0
    hashes = _once(blocks)
    places = signature(iter([hashes]))
    if places is None:
        return fp, 0, [], bytes(BINS), b""
    shingles = hashes.astype("<u8").tobytes()
    mixed = places * _ODD
    mixed ^= mixed >> np.uint64(29)
    bands = (mixed[:BANDS * BAND_ROWS] * _ODD[:BANDS * BAND_ROWS]).reshape(BANDS, BAND_ROWS).sum(1, dtype=np.uint64)
    node = np.uint64(xxhash.xxh64_intdigest(shingles, 1)).view(np.int64)
    return fp, int(node), bands.view(np.int64).tolist(), (mixed >> np.uint64(56)).astype(np.uint8).tobytes(), shingles


def _marks_column(text: str, width: int, seed: int):
    @F.pandas_udf("fp long, node long, bands array<long>, places binary, number long, shingles binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [(*m[:4], len(m[4]) // 8, m[4]) for m in (_marks(x, width, seed) for x in texts)]
        return pd.DataFrame(found, columns=["fp", "node", "bands", "places", "number", "shingles"])

    return run(whole_text(text))


def _shingles_column(text: str, width: int, seed: int):
    """The different shingle hashes of a text, as :func:`_marks` gives them."""
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([_once([*_word_shingles(x or "", width, seed)]).astype("<u8").tobytes() for x in texts], dtype=object)

    return run(whole_text(text))


def _runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], values: tuple[str, ...]) -> Iterator[list[tuple]]:
    """The values of each run of equal keys, of two rows or more, in rows sorted by key; a run may span batches."""
    at, run = None, []
    for batch in batches:
        for now, row in zip(zip(*(batch.column(c).to_pylist() for c in key), strict=True),
                            zip(*(batch.column(c).to_pylist() for c in values), strict=True), strict=True):
            if now != at:
                if len(run) > 1:
                    yield run
                at, run = now, []
            run.append(row)
    if len(run) > 1:
        yield run


def _tree(nodes: list[int], near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the links among the nodes; ``near`` tells which of some places are linked to one place."""
    left, right, rest = [], [], np.arange(len(nodes))
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            hit = near(one, rest)
            left += [nodes[one]] * int(hit.sum())
            right += [nodes[i] for i in rest[hit]]
            front += list(rest[hit])
            rest = rest[~hit]
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _likely(places: np.ndarray, number: np.ndarray, similarity: float, by_band: bool) -> Callable[[int, np.ndarray], np.ndarray]:
    """Which sets may be similar enough, by their sizes and signatures; pairs with few shingles are if ``by_band``."""
    def near(one: int, rest: np.ndarray) -> np.ndarray:
        hit = np.minimum(number[rest], number[one]) >= similarity * np.maximum(number[rest], number[one]) - 1e-9
        ask = np.flatnonzero(hit & (number[rest] + number[one] >= FEW))
        if not by_band:
            hit[:] = False
        hit[ask] = (places[rest[ask]] == places[one]).mean(1) >= similarity - LIKELY
        return hit

    return near


def _link_likely(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Forests of candidates in each run of equal (band, key, part)."""
    for run in _runs(batches, ("band", "key", "part"), ("node", "places", "number")):
        places = np.frombuffer(b"".join(r[1] for r in run), np.uint8).reshape(-1, BINS)
        yield from _tree([r[0] for r in run], _likely(places, np.array([r[2] for r in run]), similarity, by_band=True))


def _most_short(similarity: float) -> int:
    """A pair with fewer than FEW shingles together, similar enough, has no larger set."""
    return int((FEW - 1) / (1 + similarity) + 1e-6)


def _least_long(similarity: float) -> int:
    """A pair with FEW shingles or more together, similar enough, has no smaller set."""
    return math.ceil(FEW * similarity / (1 + similarity) - 1e-6)


def _short_tree(nodes: list[int], sets: list[np.ndarray], similarity: float) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the pairs of sets whose Jaccard similarity is at least ``similarity``, breadth first.

    A set that is similar enough to one of n members lacks at most the n - ceil(similarity n) others, so of any so many and 1 + MORE
    of them it has 1 + MORE: only sets that hold so many of the rarest ones are compared. A set that has been reached leaves the lists of holders.
    """
    number = np.array(list(map(len, sets)))
    start = np.concatenate(([0], np.cumsum(number)))
    owner = np.repeat(np.arange(len(sets)), number)
    _, ids, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ids = ids[np.lexsort((ids, often[ids], owner))]  # each set's members, the rarest first
    holders, ends = owner[np.argsort(ids, kind="stable")], np.cumsum(often)
    begins, ends = (ends - often).tolist(), ends.tolist()
    shared = np.maximum(1, np.ceil(similarity * number - 1e-9).astype(np.int64))
    more = np.minimum(MORE, shared - 1)
    asked, more = (start[:-1] + number - shared + 1 + more).tolist(), more.tolist()
    mine, free, n_free = np.zeros(len(often), np.int64), np.ones(len(sets), bool), len(sets)
    left, right = [], []
    for first in range(len(sets)):
        if not free[first]:
            continue
        free[first], n_free, front = False, n_free - 1, [first]
        while front and n_free:
            one = front.pop()
            rare, found = ids[start[one]:asked[one]], []
            for i in rare[often[rare] > 1].tolist():
                some = holders[begins[i]:ends[i]]
                some = some[free[some]]
                ends[i] = begins[i] + len(some)
                holders[begins[i]:ends[i]] = some
                if len(some):
                    found.append(some)
            if not found:
                continue
            found, times = np.unique(np.concatenate(found), return_counts=True)
            found = found[times > more[one]]
            found = found[np.minimum(number[found], number[one]) >= similarity * np.maximum(number[found], number[one]) - 1e-9]
            if not len(found):
                continue
            own, size = ids[start[one]:start[one + 1]], number[found]
            before = np.cumsum(size) - size
            mine[own] = 1
            both = np.add.reduceat(mine[ids[np.repeat(start[found] - before, size) + np.arange(size.sum())]], before)
            mine[own] = 0
            hit = found[both >= similarity * (len(own) + size - both) - 1e-9]
            free[hit], n_free = False, n_free - len(hit)
            left += [nodes[one]] * len(hit)
            right += [nodes[i] for i in hit]
            front += hit.tolist()
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _link_exact(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Forests of the pairs whose shingle sets have a Jaccard similarity of at least ``similarity``, in each run of equal (root, short, part):
    where ``short``, of all pairs; else of those that have FEW shingles or more together and whose signatures agree."""
    for run in _runs(batches, ("root", "short", "part"), ("node", "places", "shingles", "short")):
        nodes, sets = [r[0] for r in run], [np.frombuffer(r[2], "<u8") for r in run]
        if run[0][3]:
            yield from _short_tree(nodes, sets, similarity)
            continue
        likely = _likely(np.frombuffer(b"".join(r[1] for r in run), np.uint8).reshape(-1, BINS), np.array(list(map(len, sets))), similarity, by_band=False)

        def near(one: int, rest: np.ndarray) -> np.ndarray:
            hit = likely(one, rest)
            for i in np.flatnonzero(hit):
                few, many = sorted((sets[one], sets[rest[i]]), key=len)
                both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                hit[i] = both >= similarity * (len(few) + len(many) - both) - 1e-9
            return hit

        yield from _tree(nodes, near)


def similar_links(marks: DataFrame, similarity: float, block: int = 4096, texts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Edges (a, b) between nodes of ``marks`` (node, bands, places, number) that span every component of "found as candidates, and
    the shingle sets' Jaccard similarity is at least ``similarity``". No edge is below it; a pair at 0.8 shares a band in 99.8 % of cases.

    Only keys with several members are looked at; a key, or a component of candidates, with more than ``block`` members is dealt
    as pairs of blocks. Pairs with few shingles are candidates by one band alone, so a component of short texts grows with the whole
    table; they are sought by their rarest shingles, apart from the longer ones and in blocks of SHORT_BLOCKS times as many. ``texts`` gives (node, shingles) for rows with a node; else ``marks`` has them.
    """
    known = marks.where("number > 0").groupBy("node").agg(F.first("bands").alias("bands"), F.first("places").alias("places"), F.first("number").alias("number"))
    keys = known.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = keys.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    # Spark takes a node's sixteen keys for one row and might broadcast them
    shared = keys.hint("merge").join(sizes, ["band", "key"]).join(known.select("node", "places", "number"), "node")
    candidates = (_dealt(shared, "node", block).select("band", "key", "part", "node", "places", "number")
                  .repartition("band", "key", "part").sortWithinPartitions("band", "key", "part", "node")
                  .mapInArrow(partial(_link_likely, similarity=similarity), "a long, b long"))
    groups = stable(components(candidates))
    most, least = _most_short(similarity), _least_long(similarity)
    short = F.when(F.col("number") < least, F.array(F.lit(True))).when(F.col("number") > most, F.array(F.lit(False))).otherwise(F.array(F.lit(True), F.lit(False)))
    sorts = groups.join(known.select("node", "places", "number"), "node").select("root", "node", "places", F.explode(short).alias("short"))
    sizes = sorts.groupBy("root", "short").agg(F.count("*").alias("n")).where("n > 1")
    some = texts(groups) if texts else marks.join(groups, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))
    members = sorts.join(sizes, ["root", "short"]).join(some, "node")
    return (_dealt(members, "node", F.when(F.col("short"), SHORT_BLOCKS * block).otherwise(block)).select("root", "short", "part", "node", "places", "shingles")
            .repartition("root", "short", "part").sortWithinPartitions("root", "short", "part", "node")
            .mapInArrow(partial(_link_exact, similarity=similarity), "a long, b long"))


def _dealt(shared: DataFrame, member: str, block: int | Column) -> DataFrame:
    """Adds ``part``: members of a key with ``n`` of them meet in pairs of blocks of about ``block`` members."""
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    return (shared.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(member), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("part", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")))


def _layout(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment; widths differ by one at most."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _mask(parts: list[tuple[int, int]]) -> int:
    return sum(((1 << width) - 1) << lo for lo, width in parts)


def _chain_keys(batches: Iterator[pa.RecordBatch], bits: int, segments: int) -> Iterator[pa.RecordBatch]:
    """Rows (start, key, fp): the bucket keys of each fingerprint, see the module's text."""
    layout = _layout(segments)
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(fps):
            continue
        raw = fps.view(np.uint64)
        for start in range(segments):
            lo, width = layout[start]
            lo2, width2 = layout[(start + 1) % segments]
            first = (raw >> np.uint64(lo)) & np.uint64((1 << width) - 1)
            second = (raw >> np.uint64(lo2)) & np.uint64((1 << width2) - 1)
            keys, owner = [(first << np.uint64(width2)) | second], [fps]
            if 2 * bits // segments >= 1:
                odd = np.bitwise_count(second) % 2 == 1
                for bit in range(width2):
                    keys.append(keys[0][odd] ^ np.uint64(1 << bit))
                    owner.append(fps[odd])
            keys = np.concatenate(keys).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), start, np.int32)), pa.array(keys), pa.array(np.concatenate(owner))],
                names=["start", "key", "fp"])


def _budgets(start: int, bits: int, segments: int) -> list[tuple[np.uint64, int]]:
    """(mask, most differing bits) of the chains of 2, 3, ... segments from ``start``; the last is the whole ring."""
    layout = _layout(segments)
    return [(np.uint64(_mask([layout[(start + i) % segments] for i in range(n)])), n * bits // segments)
            for n in range(2, segments + 1)]


def _near(one: np.ndarray, many: np.ndarray, budgets: list[tuple[np.uint64, int]]) -> np.ndarray:
    """Which of ``many`` keep every chain's budget against ``one`` (broadcast), short chains first."""
    keep = np.ones(np.broadcast(one, many).shape, bool)
    differ = one ^ many
    for mask, most in budgets:
        keep &= np.bitwise_count(differ & mask) <= most
    return keep


def _forest(fps: np.ndarray, budgets: list[tuple[np.uint64, int]]) -> tuple[list[int], list[int]]:
    """Spanning forest of the links among ``fps``: breadth first, each member compared with those not yet reached."""
    left, right, rest = [], [], fps
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            hit = _near(one, rest, budgets)
            if hit.any():
                found = rest[hit]
                left += [one] * len(found)
                right += found.tolist()
                front += list(found)
                rest = rest[~hit]
    return [int(x) for x in left], [int(x) for x in right]


def _link_sorted(batches: Iterator[pa.RecordBatch], bits: int, segments: int) -> Iterator[pa.RecordBatch]:
    """Edges of each run of equal (start, part, key) in rows sorted by them; a run may span batches."""
    held = None

    def link(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        start, key, part = (frame[c].to_numpy() for c in ("start", "key", "part"))
        fps = frame["fp"].to_numpy().view(np.uint64)
        edge = np.flatnonzero((np.diff(start) != 0) | (np.diff(key) != 0) | (np.diff(part) != 0)) + 1
        first = np.concatenate(([0], edge))
        size = np.diff(np.concatenate((first, [len(fps)])))
        left, right = [], []
        for at in range(segments):
            budgets = _budgets(at, bits, segments)
            own = start[first] == at
            pairs = first[own & (size == 2)]
            hit = _near(fps[pairs], fps[pairs + 1], budgets)
            left.append(fps[pairs[hit]])
            right.append(fps[pairs[hit] + 1])
            for i in np.flatnonzero(own & (size > 2)):
                a, b = _forest(fps[first[i]:first[i] + size[i]], budgets)
                left.append(np.array(a, np.uint64))
                right.append(np.array(b, np.uint64))
        a, b = np.concatenate(left), np.concatenate(right)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        frame = batch.to_pandas()
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        last = frame.iloc[-1]
        tail = ((frame["start"] == last["start"]) & (frame["key"] == last["key"]) & (frame["part"] == last["part"])).to_numpy()
        cut = len(tail) - int(tail[::-1].argmin() if not tail.all() else len(tail))
        if cut:
            yield from link(frame.iloc[:cut])
        held = frame.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held) > 1:
        yield from link(held)


def fingerprint_links(fps: DataFrame, bits: int = 4, segments: int = 5, block: int = 4096) -> DataFrame:
    """Edges (a, b) between different values of the long column ``fp`` that span every component of
    "differs in at most ``bits`` bits".

    ``segments`` must exceed ``bits`` and be at most 2 * bits, so that the start segment is equal and the key covers
    one differing bit. A key with more than ``block`` members is dealt as pairs of blocks of about that size, so no
    task holds an unbounded group and no link is lost.
    """
    if not bits < segments <= 2 * bits:
        raise ValueError("segments must lie in bits+1 .. 2*bits")
    keys = fps.select("fp").where("fp is not null").distinct().mapInArrow(
        partial(_chain_keys, bits=bits, segments=segments), "start int, key long, fp long")
    # most keys have one member: a window needs one shuffle and sort of them, where counts and a join need two and a hash table of all.
    # And no join: Spark takes a fingerprint's forty keys for one row and would broadcast them
    shared = keys.withColumn("n", F.count("*").over(Window.partitionBy("start", "key"))).where("n > 1")
    dealt = _dealt(shared, "fp", block).select("start", "key", "fp", "part")
    return (dealt.repartition("start", "key", "part").sortWithinPartitions("start", "key", "part", "fp")
            .mapInArrow(partial(_link_sorted, bits=bits, segments=segments), "a long, b long"))


def fingerprint_classes(fps: DataFrame, bits: int = 4, segments: int = 5) -> DataFrame:
    """(fp, root) for each distinct ``fp``: root is the smallest fingerprint (as a signed long) of its component."""
    roots = components(fingerprint_links(fps, bits, segments))
    return (fps.select("fp").where("fp is not null").distinct().join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, bits: int = 4,
                    segments: int = 5, seed: int = 42) -> DataFrame:
    """One row per input row: (id, fp, component_id).

    Two rows are linked when their fingerprints differ in at most ``bits`` bits; component_id is the smallest id of
    the connected component. A null or blank text has fingerprint 0 and is linked like any other. Rows with a null id
    are linked too; a component with null ids only has a null component_id. Repeated rows and ids give one row each. Other
    columns are not read, so their names cannot clash. An empty table gives an empty result.
    """
    rows = stable(docs.select(F.col(id_col).alias("id"), simhash_column(text_col, width, seed).alias("fp")))
    classes = fingerprint_classes(rows, bits, segments)
    least = rows.groupBy("fp").agg(F.min("id").alias("least")).join(classes, "fp")
    by_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.select("fp", "root").join(by_root, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, bits: int = 4, segments: int = 5,
                  similarity: float = 0.8, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of near-duplicates: the smallest id, and of rows with that same
    id the first read; groups of null ids keep their first row.

    Two texts are linked when their SimHashes differ in at most ``bits`` bits or the sets of their ``width``-word
    shingles have a Jaccard similarity of at least ``similarity``, exactly (:func:`similar_links`); groups are the connected components. Null, empty and blank texts make one group.
    """
    row, place = "__near_dedup_row", F.struct(F.col("id").isNull().alias("none"), "id", "place")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = stable(numbered.select(F.col(row).alias("place"), F.col(id_col).alias("id"), _marks_column(text_col, width, seed).alias("m"))
                  .select("place", "id", "m.fp", "m.node", "m.bands", "m.places", "m.number"))

    def texts(nodes: DataFrame) -> DataFrame:
        one = rows.join(nodes.select("node"), "node").groupBy("node").agg(F.min("place").alias(row))
        return numbered.select(row, F.col(text_col).alias("text")).join(one, row).select("node", _shingles_column("text", width, seed).alias("shingles"))

    # every fingerprint is stood for by its smallest node, so all links are between nodes
    heads = stable(rows.groupBy("fp").agg(F.min("node").alias("head")))
    same = rows.select("fp", "node").distinct().join(heads, "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    near = (fingerprint_links(heads, bits, segments).join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a")
            .join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
    roots = components(same.unionByName(near).unionByName(similar_links(rows, similarity, texts=texts)))
    first = rows.groupBy("node").agg(F.min(place).alias("first")).join(roots, "node", "left")
    keep = stable(first.groupBy(F.coalesce("root", "node")).agg(F.min("first")["place"].alias(row)).select(row))
    return numbered.join(keep, row, "left_semi").drop(row)


def hex_fingerprint(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
