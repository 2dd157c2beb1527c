"""MinHash near-duplicates with b-bit signatures.

A document is its set of shingles, as 64-bit hashes. ``BANDS * ROWS`` minima of the set are taken under as many
multiplications. Each band of ``ROWS`` whole minima makes a key; documents that share a key are candidates. Of all
minima the lowest ``BITS`` bits of a mix stay, packed in planes of 64-bit words. Bits that differ are counted
on whole words; unlike minima agree by chance in one of ``2^BITS`` cases, for which the estimated
similarity is corrected. Candidates whose estimate is well below the limit go. So do those whose sets have too many
unlike members by a lower bound: a bitmap holds the parity of the members that fall on each bit, and two sets differ in as
many members at least as their bitmaps in bits. The others are confirmed on their full sets.

A pair at the limit of 0.8 shares no band in 3 of 10^7 cases, and falls below the estimate's limit in as few.

Equal sets are one node. Groups are found without all of their pairs: first each node is compared with one
other of its bucket, by a sixteenth of the keys, then by all; a bucket whose nodes are one group by then asks for nothing.
Buckets with several groups left compare the nodes outside the largest one with all others, so no link is lost.

Edge cases: a null or empty text, or one without words, has an empty set, which links with nothing. A text with fewer
words than a shingle is one shingle. Rows that share a doc_id are one node, if their sets have members. A null
doc_id links nothing, has a null component and is not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlode.llm.components import components
from postlode.llm.shared import batches, discard, stored, texts_of
from postlode.llm.tokens import text_groups

BANDS, ROWS, BITS = 64, 7, 2
MINIMA = BANDS * ROWS
WORDS = MINIMA // 64  # of a plane of the signature
FIRST_BANDS = 16
PARITY_BITS = 2048
MARK_BYTES = 32 << 20  # of the bitmap that tells the tasks whose full sets are needed
# Five standard deviations of the estimate at the limit.
SLACK = 0.11
_BLOCK = 32  # shingles times multipliers stay in a core's cache
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_ODD = np.random.default_rng(20).integers(0, 1 << 32, MINIMA, np.uint32) | np.uint32(1)
_FOLD = np.random.default_rng(21).integers(0, 1 << 64, ROWS, np.uint64) | np.uint64(1)

SCHEMA = (
    "doc_id long, n_shingles long, digest binary, short long, bands array<long>, signature array<long>, parities array<long>"
)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _K2
    return h ^ (h >> np.uint64(29))


def _folded(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` word hashes in a row."""
    starts = len(hashes) - size + 1
    h = np.full(starts, size, np.uint64)
    for j in range(size):
        h = _mix(h * _K1 + hashes[j : starts + j])
    return h


def shingle_sets(texts: pa.Array, shingle_words: int) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending 64-bit hashes."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    table = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    at = coded.indices.to_numpy()
    filled = np.array([bool(w) for w in words], bool)[at]  # outer white space gives empty words
    hashes = table[at[filled]]
    offsets = split.offsets.to_numpy()
    ends = np.concatenate([[0], np.cumsum(filled)])[offsets - offsets[0]]
    whole = _folded(hashes, shingle_words) if len(hashes) >= shingle_words else np.empty(0, np.uint64)
    sets = []
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if high - low >= shingle_words:
            sets.append(np.unique(whole[low : high - shingle_words + 1]))
        else:
            sets.append(_folded(hashes[low:high], high - low) if high > low else np.empty(0, np.uint64))
    return sets


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest product of the shingles' upper halves with each multiplier."""
    upper = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    space = np.empty((_BLOCK, MINIMA), np.uint32)
    for low in range(0, len(upper), _BLOCK):
        part = upper[low : low + _BLOCK]
        products = np.multiply(part, _ODD, out=space[: len(part)])
        np.minimum(least, products.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key of each band's minima, the band's number in its lowest bits; rows of ``least`` are documents."""
    h = _mix((least.reshape(len(least), BANDS, ROWS).astype(np.uint64) * _FOLD).sum(axis=2, dtype=np.uint64))
    return ((h & ~np.uint64(BANDS - 1)) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def signatures(least: np.ndarray) -> np.ndarray:
    """Planes of the lowest bits of the mixed minima, ``BITS * WORDS`` words a document."""
    mixed = _mix(least.astype(np.uint64) * _K1)
    planes = [np.packbits(((mixed >> np.uint64(b)) & np.uint64(1)).astype(bool), axis=1) for b in range(BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each bit of the bitmap, whether an odd number of shingles falls on it."""
    at = (shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=PARITY_BITS) & 1).astype(bool)).view(np.int64)


def unlike_at_least(left: str, right: str) -> Column:
    """Lower bound of the members that one of two sets has and the other has not, from their parity columns."""
    differing = F.lit(0)
    for word in range(PARITY_BITS // 64):
        differing = differing + F.bit_count(F.get(left, F.lit(word)).bitwiseXOR(F.get(right, F.lit(word))))
    return differing


def estimate(left: str, right: str) -> Column:
    """Similarity of two signature columns, corrected for bits that agree by chance."""
    differing = F.lit(0)
    for word in range(WORDS):
        unlike = F.lit(0).cast("long")
        for plane in range(BITS):
            at = plane * WORDS + word
            unlike = unlike.bitwiseOR(F.get(left, F.lit(at)).bitwiseXOR(F.get(right, F.lit(at))))
        differing = differing + F.bit_count(unlike)
    chance = 0.5**BITS
    return (1.0 - differing / float(MINIMA) - chance) / (1.0 - chance)


def _lists(values: np.ndarray, there: np.ndarray) -> pa.ListArray:
    """A row of ``values`` for each True in ``there``, an empty list for the others."""
    offsets = np.concatenate([[0], np.cumsum(there * values.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, values.ravel())


def sketches(documents: DataFrame, shingle_words: int) -> DataFrame:
    """Set size, digest, 64 bits of it, band keys, signature and parities of every row; no digest for an empty set."""

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            ids, low = batch.column(0), 0
            for texts in text_groups(batch.column(1)):
                sets = shingle_sets(texts, shingle_words)
                there = np.array([len(s) > 0 for s in sets], bool)
                least = np.array([minima(s) for s in sets if len(s)], np.uint32).reshape(-1, MINIMA)
                odd = np.array([parities(s) for s in sets if len(s)], np.int64).reshape(-1, PARITY_BITS // 64)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                columns = [
                    ids.slice(low, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([None if d is None else int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
                    _lists(band_keys(least), there), _lists(signatures(least), there), _lists(odd, there),
                ]
                names = ["doc_id", "n_shingles", "digest", "short", "bands", "signature", "parities"]
                yield pa.RecordBatch.from_arrays(columns, names)
                low += len(texts)

    return texts_of(documents).mapInArrow(run, SCHEMA)


def _marks(ids: DataFrame) -> np.ndarray:
    """A bitmap with a bit set for each id in ``id``, of 16 bits an id and of ``MARK_BYTES`` at most.

    What it lets through by chance is dropped by the digest afterwards.
    """
    n_bits = 1 << 15
    while n_bits < min(16 * ids.count(), 8 * MARK_BYTES):
        n_bits *= 2
    places = ids.select((_mark_place("id", n_bits) + 1).alias("place"))  # Spark counts from one
    buckets = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    marks = np.zeros((n_bits >> 15, 1 << 12), np.uint8)
    for bucket, bits in buckets.collect():
        marks[bucket - 1] = np.frombuffer(bits, np.uint8)
    return marks.ravel()


def _mark_place(name: str, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(n_bits).cast("long"))


def _full_sets(documents: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """``node, shingles`` of the nodes given, from their texts, which are not moved."""
    marks = _marks(nodes.select(F.col("doc").alias("id")).distinct())

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            place = batch.column(2).to_numpy()
            marked = (marks[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            for texts in text_groups(batch.column(1).filter(pa.array(marked == 1))):
                sets = [s for s in shingle_sets(texts, shingle_words) if len(s)]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
                digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [digests, pa.ListArray.from_arrays(offsets, flat)], ["digest", "shingles"]
                )

    texts = texts_of(documents).withColumn("place", _mark_place("doc_id", 8 * len(marks)))
    found = texts.where("doc_id is not null").mapInArrow(run, "digest binary, shingles array<long>")
    # An id with several texts may bring others along, and an id may stand twice with one text.
    return found.join(nodes.select("node", "digest"), "digest").select("node", "shingles").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets are similar."""
    left = full.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = full.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    counted = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("left", "right")).cast("long").alias("both"),
        (F.size("left").cast("long") + F.size("right")).alias("all"),
    )
    return counted.where(100 * F.col("both") >= percent * (F.col("all") - F.col("both"))).select("a", "b")


def _near(l: str, r: str, percent: int) -> Column:
    """What two rows with size and signature must have to be confirmed: no similar pair lacks it but by rare chance."""
    small, large = F.least(f"{l}.n", f"{r}.n"), F.greatest(f"{l}.n", f"{r}.n")
    guess = estimate(f"{l}.signature", f"{r}.signature")
    unlike = unlike_at_least(f"{l}.parities", f"{r}.parities")
    return (
        (100 * small >= percent * large) & (guess >= percent / 100 - SLACK)
        & ((100 + percent) * unlike <= (100 - percent) * (small + large))
    )


def _merged(groups: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``node, comp`` after the links; groups that a link joins take one name."""
    by_node = groups.select("node", "comp")
    ends = links.join(by_node.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a").join(
        by_node.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b"
    )
    found = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    renamed = found.select(F.col("node").alias("comp"), F.col("component").alias("joined"))
    return stored(groups.join(renamed, "comp", "left").select("node", F.coalesce("joined", "comp").alias("comp")), name)


def _star_links(rows: DataFrame, nodes: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links of nodes with one node of their bucket, that with another group's best estimate.

    ``rows`` has ``key, node, comp``, ``nodes`` has ``node, comp, n, signature, parities``. A bucket's chosen node is
    another one in each bucket.
    """
    mask = F.xxhash64("key")
    chosen = rows.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.col("node").bitwiseXOR(mask)).alias("masked")
    )
    chosen = chosen.where("lo < hi").select("key", F.col("masked").bitwiseXOR(mask).alias("chosen"))
    pairs = rows.select("key", "node").join(chosen, "key").where("node <> chosen").select("node", "chosen").distinct()
    left, right = nodes.alias("l"), nodes.select(*[F.col(c) for c in nodes.columns]).alias("r")
    both = pairs.alias("p").join(left, F.col("p.node") == F.col("l.node")).join(
        right, F.col("p.chosen") == F.col("r.node")
    )
    guess = estimate("l.signature", "r.signature")
    best = (
        both.where((F.col("l.comp") != F.col("r.comp")) & _near("l", "r", percent))
        .groupBy(F.col("l.node").alias("a")).agg(F.max_by(F.col("r.node"), guess).alias("b"))
    )
    return _confirmed(best, full, percent)


def _other_links(rows: DataFrame, nodes: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links between the groups that still share a bucket: nodes outside its largest group with all others."""
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("comp", "size").alias("largest"), F.count("*").alias("groups"))
    mixed = rows.drop("comp").join(largest.where("groups > 1").select("key", "largest"), "key")
    marked = mixed.join(nodes, "node").withColumn("outside", F.col("comp") != F.col("largest"))
    marked = stored(marked, "minhash-buckets")
    left, right = marked.where("outside").alias("l"), marked.alias("r")
    met = left.join(right, F.col("l.key") == F.col("r.key")).where(
        (F.col("l.comp") != F.col("r.comp")) & (~F.col("r.outside") | (F.col("l.node") < F.col("r.node")))
        & _near("l", "r", percent)
    )
    pairs = met.select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()
    return _confirmed(pairs, full, percent)


def _groups(documents: DataFrame, sets: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """``digest, component``: the smallest doc_id that a set's links reach."""
    usable = sets.where("digest is not null and doc_id is not null")
    firsts = usable.groupBy("digest", "short").agg(F.min("doc_id").alias("doc"))
    nodes = stored(firsts.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    # Rows of keys that several sets have; few documents have any. Copies fall together in the map tasks.
    keyed = usable.select("short", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("short").alias("lo"), F.max("short").alias("hi")).where("lo < hi")
    met = keyed.join(shared.select("key"), "key").distinct()
    members = stored(met.join(nodes.select("short", "node"), "short").select("key", "node"), "minhash-members")
    within = nodes.join(members.select("node").distinct(), "node").select("node", "doc", "digest")
    wide = usable.select("doc_id", "digest", F.col("n_shingles").alias("n"), "signature", "parities")
    same = (wide["digest"] == within["digest"]) & (wide["doc_id"] == within["doc"])
    own = wide.join(within, same).select("node", "doc", within["digest"], "n", "signature", "parities")
    details = stored(own.dropDuplicates(["node"]), "minhash-details")
    full = stored(_full_sets(documents, details, shingle_words), "minhash-sets")

    early = members.where(F.col("key").bitwiseAND(BANDS - 1) < FIRST_BANDS)
    groups = details.select("node", F.col("node").alias("comp"))
    known = details.select("node", "n", "signature", "parities")
    for find, among in ((_star_links, early), (_star_links, members), (_other_links, members)):
        links = find(among.join(groups, "node"), known.join(groups, "node"), full, percent)
        groups = _merged(groups, stored(links, "minhash-links"), "minhash-groups")
    for done in (members, full):
        discard(done)
    # Ids with several sets make these sets one.
    several = sets.where("digest is not null").groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    several = several.where("doc_id is not null and lo < hi").select("doc_id", "lo")
    sides = sets.select("doc_id", "digest").join(several, "doc_id").where("digest <> lo").select("lo", "digest").distinct()
    named = nodes.join(groups, "node", "left").select("digest", "doc", F.coalesce("comp", "node").alias("comp"))
    named = stored(named, "minhash-named")
    ends = sides.join(named.select(F.col("digest").alias("lo"), F.col("comp").alias("a")), "lo").join(
        named.select("digest", F.col("comp").alias("b")), "digest"
    )
    joined = components(ends.select("a", "b")).select(F.col("node").alias("comp"), F.col("component").alias("joined"))
    final = named.join(joined, "comp", "left").select("digest", "doc", F.coalesce("joined", "comp").alias("comp"))
    smallest = final.groupBy("comp").agg(F.min("doc").alias("component"))
    return final.join(smallest, "comp").select("digest", "component")


def near_duplicates(documents: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two sets link if 100 times their intersection is at least ``percent`` times their union.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the bands find links of 80 percent or more")
    if shingle_words < 1:
        raise ValueError("a shingle has a word at least")
    sets = stored(sketches(documents, shingle_words), "minhash-sketches")
    groups = _groups(documents, sets, shingle_words, percent)
    # An empty set looks for nothing, under a key of its own: nulls would all meet in one task.
    key = F.coalesce("digest", F.concat(F.lit("-"), F.col("doc_id").cast("string")).cast("binary"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return sets.select("doc_id", "n_shingles", key.alias("digest")).join(groups, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def one_per_group(documents: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of documents with the smallest id of their group; rows without an id all stay."""
    found = near_duplicates(documents, shingle_words, percent)
    gone = found.where("doc_id is not null and not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"].cast("long") == gone["_gone"], "left_anti")
