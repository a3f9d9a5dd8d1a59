"""Exact Jaccard join of shingle sets: universe partition, pigeonhole, one-deletion neighbours.

Sets of similarity t or more differ in at most H = (x + y)(1 - t)/(1 + t) elements. A hash cuts
the universe into segments. Each segment is allotted a tolerance: 0 (its subset is indexed) or 1
(its subset and that without each one element are indexed). If the tolerances plus one sum to
H + 1, two similar sets share an entry of at least one segment. Sizes are cut into bands, so that
H and the segments are fixed for each band; similar sets lie in the same or neighbouring bands.

Empty segments say nothing, and all sets would share them. The sum need only count segments that
are not empty (with tolerance 1: have two elements) in one of both sets. So there are a few more
segments than needed, and only a set whose own sum falls short indexes its empty ones as well: a
pair of two such sets still meets there.

Sets that share an entry are compared with the lowest of them, the entry's head p. What is left to
find are links between sets x and y of which one is not linked to p. Such a link needs common
elements of the differences x ^ p and y ^ p, because without any, x ^ y would be as large as both
together, and y is never closer than p itself. How many are needed is known, so x and y meet on the
first few elements of their differences, the rare ones first. Those are mostly their own edits, so
that unlike sets which only have a passage in common seldom meet. No group is paired out.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import WordHashes, map_batches, mix, shingle_set, text_bytes
from promolens.llm.components import connected_components
from promolens.session import release_shuffles, remove_staged, stage

SHINGLE = 3
PERCENT = 90
VERIFY_COST = 300.0  # of comparing two documents, in index entries
MAX_SIZE = 1 << 40
CHUNK = 400_000
RUN = 2000  # pairs of a head that one task holds together
RUN_ELEMENTS = 2_000_000  # of their sets
FEW = 100  # sets that tell which elements are frequent, where a head has more pairs
_MASK = (1 << 64) - 1


def size_bands(percent: int) -> list[int]:
    """Least size of each band: a set never reaches beyond the next band."""
    bounds = [1]
    while bounds[-1] < MAX_SIZE:
        bounds.append(100 * bounds[-1] // percent + 1)
    return bounds


def most_different(x: int, y: int, percent: int) -> int:
    """Most elements in which linked sets of these sizes can differ."""
    return (x + y) * (100 - percent) // (100 + percent)


def allocate(
    records: int, size: int, budget: int, verify_cost: float = VERIFY_COST
) -> tuple[int, int]:
    """(segments, of them with tolerance 1) of least estimated cost for sets of this size.

    Costs of a record: its index entries, and comparisons by chance. Chance has two sources. If
    the segments in use fall short of ``budget``, the empty ones are indexed too. Entries of a
    single element are shared by unrelated records, the more of them there are.
    """
    best = None
    for factor in np.linspace(0.5, 3, 51):
        segments = max(1, math.ceil(budget * factor))
        for share in (0.0, 0.25, 0.5, 0.75, 1.0):
            tolerant = int(segments * share)
            exact = segments - tolerant
            mean = size / segments
            empty, single = math.exp(-mean), mean * math.exp(-mean)
            used = exact * (1 - empty) + 2 * tolerant * (1 - empty - single)
            spread = math.sqrt(
                exact * empty * (1 - empty)
                + 4 * tolerant * (empty + single) * (1 - empty - single)
                + 1e-9
            )
            short = 0.5 * math.erfc((used - budget) / spread / math.sqrt(2))
            entries = exact * (1 - empty) + tolerant * (1 + mean)
            alone = exact * single + tolerant * (single + mean * single)
            chance = short * segments * empty + alone * min(1.0, records * 1e-7)
            cost = entries + verify_cost * chance
            if segments + tolerant >= budget and (best is None or cost < best[0]):
                best = (cost, segments, tolerant)
    return best[1], best[2]


def plan_bands(counts: dict[int, int], percent: int) -> dict[int, tuple[int, int, int]]:
    """(segments, tolerant, budget) by label; label k is for pairs in band k, or k - 1 and k."""
    bounds = size_bands(percent)
    plan = {}
    for label in {k + i for k in counts for i in (0, 1)}:
        if label + 1 >= len(bounds):
            continue
        largest = bounds[label + 1] - 1
        records = counts.get(label, 0) + counts.get(label - 1, 0)
        differ = most_different(largest, largest, percent)
        # With no difference allowed only equal sets are linked, and those are one class already.
        if differ and records > 1:
            smallest = bounds[max(label - 1, 0)]
            plan[label] = (*allocate(records, smallest, differ + 1), differ + 1)
    return plan


def index_entries(
    tokens: np.ndarray, label: int, segments: int, tolerant: int, budget: int
) -> np.ndarray:
    """Hashes of a set's segments; for the first ``tolerant`` also without each one element.

    Empty subsets are left out unless the segments in use do not reach ``budget``.
    """
    salt = np.uint64(0x9E3779B97F4A7C15 * (2 * label + 1) & _MASK)
    place = (((tokens * salt) >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    place = place.astype(np.int64)
    # Sums modulo 2**64 as two halves, exact in doubles.
    low = np.bincount(place, (tokens & np.uint64(0xFFFFFFFF)).astype(float), segments)
    high = np.bincount(place, (tokens >> np.uint64(32)).astype(float), segments)
    sums = (high.astype(np.uint64) << np.uint64(32)) + low.astype(np.uint64)
    counts = np.bincount(place, minlength=segments)
    used = np.count_nonzero(counts[tolerant:]) + 2 * np.count_nonzero(counts[:tolerant] > 1)
    everything = used < budget
    where = np.arange(segments) if everything else np.flatnonzero(counts)
    sums_of = sums[where]
    if tolerant:
        near = (place < tolerant) & (everything | (counts[place] > 1))
        sums_of = np.concatenate([sums_of, sums[place[near]] - tokens[near]])
        where = np.concatenate([where, place[near]])
    tag = np.uint64(0xD6E8FEB86659FD93 * (label + 1) & _MASK)
    return mix(mix(where.astype(np.uint64) + tag) + sums_of)


def set_hash(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def document_sets(rows: DataFrame, n: int) -> DataFrame:
    """(_key, _hash, n_shingles, _cls) of rows (_key, _hash, _data); _cls is NULL for no words."""
    kind = dict(rows.dtypes)["_key"]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        cache = WordHashes()
        for batch in batches:
            sets = [shingle_set(data, n, cache) for data in batch["_data"]]
            yield {
                "_key": batch["_key"],
                "_hash": batch["_hash"],
                "n_shingles": [len(s) for s in sets],
                "_cls": [set_hash(s) if len(s) else None for s in sets],
            }

    return map_batches(rows, run, f"_key {kind}, _hash long, n_shingles long, _cls long")


def pack_longs(values: np.ndarray) -> bytes:
    """64-bit numbers, byte planes apart, compressed: equal or rising high bytes cost little."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_longs(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _pack_chunk(entry: np.ndarray, cls: np.ndarray, parts: int) -> dict:
    """A chunk's entries, grouped and dealt out: first classes by entry, others by themselves.

    Rows hold sorted arrays of one part: entries with a last bit that tells if the chunk has
    others, and the classes they belong to.
    """
    order = np.lexsort((cls, entry))
    entry, cls = entry[order], cls[order]
    keep = np.concatenate(([True], (entry[1:] != entry[:-1]) | (cls[1:] != cls[:-1])))
    entry, cls = entry[keep], cls[keep]
    first = np.concatenate(([True], entry[1:] != entry[:-1]))
    others = np.append(~first[1:], False)
    apart = mix(entry ^ mix(cls.view(np.uint64)))
    part = (np.where(first, mix(entry), apart) % np.uint64(parts)).astype(np.int64)
    marked = entry * np.uint64(2) + others
    out = {"_part": [], "_known": [], "_entries": [], "_index": [], "_classes": []}
    for known in (False, True):
        chosen = np.flatnonzero(first != known)
        chosen = chosen[np.argsort(part[chosen], kind="stable")]
        for some in np.split(chosen, np.flatnonzero(np.diff(part[chosen])) + 1):
            if len(some):
                classes, index = np.unique(cls[some], return_inverse=True)
                row = (int(part[some[0]]), known, pack_longs(marked[some]),
                       pack_longs(index), pack_longs(classes))
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
    return out


def shared_entries(rows: DataFrame, n: int, percent: int, plan: dict) -> DataFrame:
    """(_cls, _head, _wide): classes that share an index entry with others, and the entry's head.

    ``_wide`` tells if a third class may share one of the entries: only then can a link be missed
    that this comparison with the head does not find. The result is a staged table.

    Entries are 48-bit hashes: a collision costs a comparison. Tasks group them in large chunks
    and send packed arrays. The lowest class of an entry in a chunk goes where the entry belongs;
    the others are known to be shared, are dealt out by themselves and get their head by a join,
    which can be split. So an entry that a third of all classes have is spread out.
    """
    bounds = size_bands(percent)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def index(batches: Iterator[dict]) -> Iterator[dict]:
        cache = WordHashes()
        entries, classes, size = [], [], 0
        for batch in batches:
            for data in batch["_data"]:
                tokens = shingle_set(data, n, cache)
                if not len(tokens):
                    continue
                band = bisect_right(bounds, len(tokens)) - 1
                for label in (band, band + 1):
                    if label in plan:
                        found = index_entries(tokens, label, *plan[label]) >> np.uint64(16)
                        entries.append(found)
                        classes.append(np.full(len(found), set_hash(tokens)))
                        size += len(found)
                if size >= CHUNK:
                    yield _pack_chunk(np.concatenate(entries), np.concatenate(classes), parts)
                    entries, classes, size = [], [], 0
        if size:
            yield _pack_chunk(np.concatenate(entries), np.concatenate(classes), parts)

    def group(batches: Iterator[dict]) -> Iterator[dict]:
        entries, classes = [], []
        for batch in batches:
            for known, entry, at, cls in zip(
                *(batch[c] for c in ("_known", "_entries", "_index", "_classes")), strict=True
            ):
                entry = unpack_longs(entry)
                cls = unpack_longs(cls).view(np.int64)[unpack_longs(at).view(np.int64)]
                if known:
                    yield {"_entry": (entry >> np.uint64(1)).view(np.int64), "_cls": cls}
                else:
                    entries.append(entry)
                    classes.append(cls)
        if not entries:
            return
        entry, cls = np.concatenate(entries), np.concatenate(classes)
        order = np.lexsort((cls, entry >> np.uint64(1)))
        entry, cls = entry[order], cls[order]
        others, entry = (entry & np.uint64(1)).astype(bool), (entry >> np.uint64(1)).view(np.int64)
        first = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
        sizes = np.diff(np.append(first, len(entry)))
        keep = np.repeat((sizes > 1) | np.logical_or.reduceat(others, first), sizes)
        yield {"_entry": entry[keep], "_cls": cls[keep]}

    packed = map_batches(
        rows, index, "_part int, _known boolean, _entries binary, _index binary, _classes binary"
    )
    shared = stage(
        map_batches(packed.repartition("_part"), group, "_entry long, _cls long"),
        "jaccard-entries",
    )
    del packed
    release_shuffles(rows.sparkSession)
    # The head is the class with the most shared entries: in a group of near copies one with few
    # edits of its own, which is close to all others.
    scores = shared.groupBy(F.col("_cls").alias("_c")).agg(F.count(F.lit(1)).alias("_score"))
    heads = (
        shared.join(scores, shared["_cls"] == scores["_c"])
        .groupBy(F.col("_entry").alias("_of"))
        # A class that lies in several chunks counts more than once: never too few.
        .agg(F.max(F.struct("_score", "_cls")).alias("_best"), F.count(F.lit(1)).alias("_n"))
    )
    headed = shared.join(heads, shared["_entry"] == heads["_of"])
    pairs = (
        headed.select("_cls", F.col("_best._cls").alias("_head"), (F.col("_n") > 2).alias("_wide"))
        .groupBy("_cls", "_head")
        .agg(F.max("_wide").alias("_wide"))
    )
    found = stage(pairs, "jaccard-shared")
    remove_staged(rows.sparkSession, shared)
    release_shuffles(rows.sparkSession)
    return found


def prefix_length(p: int, x: int, differ: int, linked: bool, percent: int) -> int:
    """How many first elements of the difference x ^ p have one that x shares with other sets.

    Those are the sets that x may be linked to though p does not say so. If x is not linked to p, a
    link of x needs at least |x ^ p| - H common elements; if it is, at least what keeps the other
    one unlinked to p. All but that many, less one, are in the prefix.
    """
    apart, both = 100 - percent, 100 + percent
    if linked:
        need = (both * differ + apart * (p - x)) // (2 * both) + 1
    else:
        need = differ - apart * (x + 100 * x // percent) // both
    return max(0, differ - max(1, need) + 1)


def delta_prefix(
    p: np.ndarray, x: np.ndarray, linked: bool, percent: int, often: np.ndarray | None = None
) -> tuple[int, np.ndarray]:
    """Size of the difference x ^ p, and the elements of it on which x meets other sets.

    Elements that p lacks come first, and of them those that are not in the sorted ``often``; that
    order is the same for all sets compared with p.
    """
    own = np.setdiff1d(x, p, assume_unique=True)
    if often is not None and len(often):
        at = np.minimum(np.searchsorted(often, own), len(often) - 1)
        own = own[np.argsort(often[at] == own, kind="stable")]
    delta = np.concatenate([own, np.setdiff1d(p, x, assume_unique=True)])
    size = len(delta)
    return size, delta[: prefix_length(len(p), len(x), size, linked, percent)]


def rare_prefixes(
    p: int, rows: list[tuple[int, bool, np.ndarray]], percent: int
) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Places and elements on which sets meet, of all rows (|x|, linked, x ^ p) of one head.

    The order is by the number of differences that hold an element, so that what many unlike sets
    share comes last. Elements of one difference alone, or only of those of sets that are linked to
    p, meet nothing and are left out: a difference without others has None.
    """
    sizes = np.array([len(delta) for _, _, delta in rows])
    values, index, often = np.unique(
        np.concatenate([delta for _, _, delta in rows]), return_inverse=True, return_counts=True
    )
    loose = np.repeat(np.array([not linked for _, linked, _ in rows]), sizes)
    meets = (often > 1) & (np.bincount(index, loose, len(values)) > 0)
    found = []
    ends = np.cumsum(sizes)
    for (x, linked, _), start, end in zip(rows, ends - sizes, ends, strict=True):
        own = index[start:end]
        own = own[np.lexsort((own, often[own]))]
        own = own[: prefix_length(p, x, end - start, linked, percent)]
        place = np.flatnonzero(meets[own])
        found.append((place.astype(np.int32), values[own[place]]) if len(place) else None)
    return found


def packed_texts(rows: DataFrame) -> DataFrame:
    """(_cls, _data) with each text compressed by itself."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield {"_cls": batch["_cls"], "_data": [pack(data) for data in batch["_data"]]}

    return map_batches(rows, run, "_cls long, _data binary")


def packed_set(data: bytes, n: int, cache: WordHashes) -> np.ndarray:
    return shingle_set(zstandard.ZstdDecompressor().decompress(data), n, cache)


def _often(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(_of, _often): elements that several of a few sets b of each head a hold, sorted."""
    first = Window.partitionBy("a").orderBy(F.xxhash64("b"), "b")
    few = pairs.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= FEW)
    few = few.join(texts, few["b"] == texts["_cls"]).select("a", "_data")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        cache, held, sets = WordHashes(), None, []

        def several() -> dict:
            values, counts = np.unique(np.concatenate(sets), return_counts=True)
            return {"_of": [held], "_often": [values[counts > 1].view(np.int64)]}

        for batch in batches:
            for a, data in zip(batch["a"], batch["_data"], strict=True):
                if sets and a != held:
                    yield several()
                    sets = []
                held = a
                sets.append(packed_set(data, n, cache))
        if sets:
            yield several()

    return map_batches(
        few.repartition("a").sortWithinPartitions("a"), run, "_of long, _often array<long>"
    )


def verify(
    pairs: DataFrame, texts: DataFrame, n: int, percent: int, name: str
) -> DataFrame:
    """``compare`` as staged tables of this name. Pairs are taken in groups of heads, with about
    as many pairs as there are texts; what a group shuffled goes before the next one.
    """
    groups = max(1, -(-pairs.count() // max(1, texts.count())))
    done = []
    for k in range(groups):
        some = pairs.where(F.pmod(F.xxhash64("a"), F.lit(groups)) == k) if groups > 1 else pairs
        done.append(stage(compare(some, texts, n, percent), name))
        release_shuffles(pairs.sparkSession)
    return reduce(DataFrame.unionByName, done)


def compare(
    pairs: DataFrame, texts: DataFrame, n: int, percent: int
) -> DataFrame:
    """(a, b, linked, size, delta, place, prefix) of pairs (a, b, wide): common shingles counted.

    Texts are dealt out once, to the heads a and to the pairs; the text of a head leads its pairs,
    and its set is made once for all of them. A head of more than ``RUN`` pairs is spread out.
    ``size`` is that of b's set; ``delta`` is the size of its difference to a, and ``prefix`` the
    elements of that on which it can meet others, with their places, for wide pairs alone. A head
    whose pairs are together orders elements by how many of them hold one; for others a few of
    their pairs tell which elements are frequent.
    """
    heads = pairs.groupBy(F.col("a").alias("_of")).agg(
        F.ceil(F.count(F.lit(1)) / RUN).cast("int").alias("_parts"),
        F.coalesce(F.max("wide"), F.lit(False)).alias("_any"),
    )
    dealt = pairs.join(heads, pairs["a"] == heads["_of"]).drop("_of")
    leads = heads.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    if heads.where("_parts > 1 and _any").limit(1).count():
        often = _often(dealt.where("_parts > 1 and wide").select("a", "b"), texts, n)
        leads = leads.join(often, "_of", "left")
    else:
        leads = leads.withColumn("_often", F.lit(None).cast("array<long>"))
    wanted = dealt.selectExpr(
        "b as _want", "a", "cast(pmod(xxhash64(b), _parts) as int) as _part", "b", "wide",
        "_parts = 1 as _whole", "cast(null as array<long>) as _often",
    ).unionByName(leads.selectExpr(
        "_of as _want", "_of as a", "_part", "cast(null as long) as b",
        "cast(null as boolean) as wide", "_parts = 1 as _whole", "_often",
    ))
    joined = (
        wanted.join(texts, wanted["_want"] == texts["_cls"])
        .select("a", "_part", "b", "wide", "_whole", "_often", "_data")
        .repartition("a", "_part")
        .sortWithinPartitions("a", "_part", F.col("b").asc_nulls_first())
    )

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        names = ("a", "b", "linked", "size", "delta", "place", "prefix")
        cache, head, tokens, often, whole = WordHashes(), None, None, None, True
        out, held, elements = {c: [] for c in names}, [], 0

        def put(*values) -> None:
            for c, v in zip(names, values, strict=True):
                out[c].append(v)

        def put_alone(b: int, linked: bool, others: np.ndarray) -> None:
            delta, prefix = delta_prefix(tokens, others, linked, percent, often)
            put(head, b, linked, len(others), delta, np.arange(len(prefix), dtype=np.int32),
                prefix.view(np.int64))

        def put_held() -> None:
            if held:
                rows = [
                    (len(others), linked, np.setxor1d(tokens, others, assume_unique=True))
                    for _, linked, others in held
                ]
                found = rare_prefixes(len(tokens), rows, percent)
                for (b, linked, others), row, some in zip(held, rows, found, strict=True):
                    place, prefix = some or (None, None)
                    put(head, b, linked, len(others), len(row[2]), place,
                        None if some is None else prefix.view(np.int64))
                held.clear()

        for batch in batches:
            for a, b, wide, together, common, data in zip(
                *(batch[c] for c in ("a", "b", "wide", "_whole", "_often", "_data")), strict=True
            ):
                others = packed_set(data, n, cache)
                if b is None:
                    put_held()
                    head, tokens, whole, elements = a, others, together, 0
                    often = None if common is None else np.array(common, np.int64).view(np.uint64)
                    continue
                common = len(np.intersect1d(tokens, others, assume_unique=True))
                linked = 100 * common >= percent * (len(tokens) + len(others) - common)
                if not wide:
                    put(a, b, linked, len(others), None, None, None)
                elif whole:
                    held.append((b, linked, others))
                    elements += len(tokens) + len(others)
                    if elements > RUN_ELEMENTS:  # too long texts to hold: all rows of the head
                        whole = False
                        for row in held:
                            put_alone(*row)
                        held.clear()
                else:
                    put_alone(b, linked, others)
            yield out
            out = {c: [] for c in names}
        put_held()
        yield out

    return map_batches(
        joined,
        run,
        "a long, b long, linked boolean, size long, delta long, place array<int>,"
        " prefix array<long>",
    )


def _across(stars: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet on a difference to a common head.

    The staged ``stars`` are removed once those that matter are written.
    Both share an entry with the head and with each other, so that only wide pairs take part.

    Only the first element that two differences share has to count, and what follows it in both
    must suffice for the common elements that a link needs.
    """
    names = labels.selectExpr("node as _node", "component as _component")

    def named(df: DataFrame, column: str, name: str) -> DataFrame:
        joined = df.join(names, df[column] == names["_node"], "left")
        return joined.select(
            *(df[c] for c in df.columns), F.coalesce("_component", df[column]).alias(name)
        )

    stars = stars.where("prefix is not null")
    # Only where components differ can a link be missing: first by head, then by element.
    heads = stars.where("not linked").select("a").distinct()
    near = named(
        stars.drop("place", "prefix").join(heads, "a", "left_semi"), "b", "component"
    ).groupBy("a").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = named(
        stars.join(near.where("lo <> hi").select("a"), "a", "left_semi"), "b", "component"
    )
    mixed = stage(mixed, "jaccard-mixed")
    remove_staged(stars.sparkSession, stars)
    release_shuffles(stars.sparkSession)
    # Rows of an element hold as little as they can; what else is asked of their sets joins those
    # that are left. Two elements of one hash are one more pair to verify.
    tokens = mixed.select(
        "a", "b", "component", F.explode(F.arrays_zip("place", "prefix")).alias("_at")
    ).select(
        "a", "b", "component", "_at.place", F.xxhash64("a", "_at.prefix").alias("meet")
    )
    several = (
        tokens.groupBy("meet")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi")
        .select("meet")
    )
    met = tokens.select("a", "b", "place", "meet").join(several, "meet", "left_semi")
    met = stage(met, "jaccard-met")
    release_shuffles(stars.sparkSession)
    own = mixed.select("a", "b", "linked", "component", "size", "delta")
    left = stage(met.join(own, ["a", "b"]), "jaccard-meeting")
    remove_staged(stars.sparkSession, met)
    remove_staged(stars.sparkSession, mixed)
    release_shuffles(stars.sparkSession)
    x, y = left.where("not linked").alias("x"), left.alias("y")
    allowed = f"({100 - percent} * (x.size + y.size) div {100 + percent})"
    after = "least(x.delta - x.place, y.delta - y.place)"
    pairs = x.join(
        y,
        F.expr(
            "x.meet = y.meet AND x.a = y.a AND x.component <> y.component"
            f" AND 2 * {after} >= x.delta + y.delta - {allowed}"
        ),
    )
    found = pairs.selectExpr("least(x.b, y.b) as a", "greatest(x.b, y.b) as b").distinct()
    found = stage(found.withColumn("wide", F.lit(False)), "jaccard-across")
    remove_staged(stars.sparkSession, left)
    return found


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, component, text_hash.

    Documents link when 100 * common >= percent * all of their distinct ``n``-word shingles (A-Z
    in lower case; the whole sequence for fewer words). ``component_id`` is the smallest key that
    links reach; a text without words (or NULL) has no shingles and its own key. Keys that repeat
    give a row each; a NULL key is the smallest only among NULLs. ``text_hash`` is xxhash64 of the
    text's bytes. Texts of any length are compared whole, and an empty table gives an empty one.
    Other columns are not read.

    Equal sets are one class before any pair is made. Classes are compared with the lowest class
    of each index entry they share, and then, in different components, where their differences to
    it meet; so no link between components can be missed.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    rows = docs.select(F.col(key).alias("_key"), text_bytes(text).alias("_data")).withColumn(
        "_hash", F.xxhash64("_data")
    )
    sets = stage(document_sets(rows, n), "jaccard-sets")
    bounds = size_bands(percent)
    band = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("n_shingles"))) - 1
    counts = {
        r["band"]: r["count"]
        for r in sets.where("n_shingles > 0").groupBy(band.alias("band")).count().collect()
    }  # one row per band: at most len(bounds)
    plan = plan_bands(counts, percent)
    shared = shared_entries(rows.where("octet_length(_data) > 0"), n, percent, plan)
    members = shared.select("_cls").distinct()
    chosen = (
        sets.where("_cls is not null")
        .groupBy("_cls")
        .agg(F.min(F.struct("_key", "_hash")).alias("s"))
        .join(members, "_cls", "left_semi")
        .select("_cls", F.col("s._key").alias("_k"), F.col("s._hash").alias("_h"))
    )
    found = rows.join(
        chosen, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h"))
    ).select("_cls", "_data")
    # Only equal rows of one key give a class two texts; others need no shuffle to tell.
    if sets.groupBy("_key", "_hash").count().where("count > 1").limit(1).count():
        found = found.dropDuplicates(["_cls"])
    texts = stage(packed_texts(found), "jaccard-texts")
    del found
    release_shuffles(docs.sparkSession)
    pairs = shared.where("_cls <> _head").selectExpr("_head as a", "_cls as b", "_wide as wide")
    stars = verify(pairs, texts, n, percent, "jaccard-stars")
    remove_staged(docs.sparkSession, shared)
    links = stage(stars.where("linked").select("a", "b"), "jaccard-links")
    labels = stage(connected_components(links), "jaccard-components")
    meeting = _across(stars, labels, percent)
    across = verify(meeting, texts, n, percent, "jaccard-compared")
    more = stage(across.where("linked").select("a", "b"), "jaccard-more")
    remove_staged(docs.sparkSession, across)
    remove_staged(docs.sparkSession, texts)
    release_shuffles(docs.sparkSession)
    if more.limit(1).count():
        labels = stage(connected_components(links.unionByName(more)), "jaccard-components")
    return _with_components(sets, labels, key)


def _with_components(sets: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    classes = sets.where("_cls is not null").groupBy("_cls").agg(F.min("_key").alias("_least"))
    named = classes.join(labels, classes["_cls"] == labels["node"], "left").select(
        "_cls", "_least", F.coalesce("component", "_cls").alias("_component")
    )
    least = named.groupBy("_component").agg(F.min("_least").alias("_id"))
    by_class = named.join(least, "_component").select(
        F.col("_cls").alias("_of"), "_id", F.col("_component").alias("component")
    )
    return sets.join(by_class, sets["_cls"] == by_class["_of"], "left").select(
        F.col("_key").alias(key),
        "n_shingles",
        F.coalesce("_id", "_key").alias("component_id"),
        "component",
        F.col("_hash").alias("text_hash"),
    )


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does: the smallest key.

    NULL keys are the largest; of equal keys the smallest text hash stays, of equal rows one.
    Texts without words are in no group and all stay.
    """
    found = near_duplicates(docs, key, text, n, percent)
    rank = F.struct(F.col(key).isNull(), F.col(key).alias("k"), F.col("text_hash").alias("h"))
    best = found.where("component is not null").groupBy("component").agg(F.min(rank).alias("s"))
    keep = stage(
        best.selectExpr("s.k as _key", "s.h as _hash").unionByName(
            found.where("component is null")
            .selectExpr(f"`{key}` as _key", "text_hash as _hash")
            .distinct()
        ),
        "jaccard-keep",
    )
    kept = _chosen(docs, keep, key, text, "left_semi")
    equal = (
        found.where("component is not null")
        .groupBy(F.col(key).alias("_key"), F.col("text_hash").alias("_hash"))
        .count()
        .where("count > 1")
    )
    if equal.limit(1).count():  # equal rows of one key: only one stays
        one = _chosen(kept, equal, key, text, "left_semi")
        one = one.withColumn("_text_hash", F.xxhash64(text_bytes(text)))
        one = one.dropDuplicates([key, "_text_hash"]).drop("_text_hash")
        kept = _chosen(kept, equal, key, text, "left_anti").unionByName(one)
    return kept


def _chosen(docs: DataFrame, chosen: DataFrame, key: str, text: str, how: str) -> DataFrame:
    same = docs[key].eqNullSafe(chosen["_key"]) & (
        F.xxhash64(F.coalesce(docs[text].cast("binary"), F.lit(b""))) == chosen["_hash"]
    )
    return docs.join(chosen, same, how)
