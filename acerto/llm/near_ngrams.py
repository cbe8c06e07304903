"""Jaccard join of word shingles by grouped prefixes.

A document's set are the 64-bit hashes of its distinct shingles. All sets are ordered by one global
order, rare shingles first (by a count sketch of fixed size, then by hash). Two sets with a
Jaccard similarity of `percent` % share a shingle in their prefixes of
n - ceil(percent % of n) + 1 shingles. Documents with equal prefix and size form one group, and
equal sets inside it one class. Group pairs come from shared prefix shingles and the size filter; they are
expanded to classes and verified on the whole sets.

Only components are asked for, so pairs inside a component need no verification. Three
passes use that. The first verifies neighbours in each shingle's list; the second neighbours among
one class of each component so far; both are linear in the lists. The third verifies every pair
across components for which a common prefix shingle may be the first common one, so no link is lost.
Lists of two are done with after the first pass.

Each set also has a bitmap of parities: 512 for every set, and one of twice its size for larger ones. Two bitmaps differ in
no more bits than their sets differ in shingles, so a pair whose bitmaps differ in too many is no link. The wide ones
keep pairs from being verified, the others keep them from being formed in the third pass (they say little on sets
of over 1,000 shingles).

Inside, a document goes by its id, which must have one text. Where some id has several, all rows are numbered and joined by
their numbers, which then go back to ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, free_held, settle, slices, small_batches, written
from .components import components

_CHUNK = 1 << 20
_LIST = 65536  # a longer list of a shingle is cut in the first pass
_BITS = 512  # of the bitmap that every set has
_SALTED = 0x4C957F2D  # makes lists of a cut shingle different
_PART = 4096  # entries in a part of a list in the third pass
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240607)
_BYTES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_PLACES = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * 2 + 1
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base and of its inverse


def mixed(x: np.ndarray, key: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit numbers, another one for each `key`."""
    x = x ^ np.uint64(key * 0xA0761D6478BD642F % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            _powers[k] = np.cumprod(np.append(np.uint64(1), np.full(size, base, np.uint64)))
    return _powers[0], _powers[1]


def _words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in `data` (bytes); `breaks` (flags) start a new document."""
    starts, hashes = [], []
    at = 0
    while at < len(data):
        stop = min(at + _CHUNK, len(data))
        if stop < len(data):  # cut between words
            back = np.flatnonzero(_SPACES[data[at:stop]])
            if len(back):
                stop = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(_SPACES[data[stop:]])
                stop = stop + int(ahead[0]) + 1 if len(ahead) else len(data)
        part = _LOWER[data[at:stop]]
        inside = ~_SPACES[part]
        before = np.append(False, inside[:-1]) & ~breaks[at:stop]
        first = np.flatnonzero(inside & ~before)
        after = np.append(inside[1:] & ~breaks[at + 1:stop], False)
        last = np.flatnonzero(inside & ~after) + 1
        power, inverse = _power(len(part) + 1)
        sums = np.append(np.uint64(0), np.cumsum(_BYTES[part] * power[:len(part)]))
        found = (sums[last] - sums[first]) * inverse[first]
        starts.append(first + at)
        hashes.append(mixed(found ^ (last - first).astype(np.uint64)))
        at = stop
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all texts: hashes, sorted within each text, and where each text's begin
    (one place more than texts)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    starts, words = _words(data, breaks[:len(data)])
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), counts)
    total = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        total += words[k:k + len(total)] * _PLACES[k]
    whole = owner[:len(total)] == owner[size - 1:] if len(total) else np.empty(0, bool)
    hashes, owners = mixed(total[whole]), owner[:len(total)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        lone = [int(np.sum(words[bounds[i]:bounds[i + 1]] * _PLACES[:counts[i]], dtype=np.uint64)) for i in short]
        hashes = np.append(hashes, mixed(np.array(lone, np.uint64), 1))
        owners = np.append(owners, short)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[fresh], np.searchsorted(owners[fresh], np.arange(len(texts) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums, modulo 2 ** 64, of the stretches between `bounds`."""
    sums = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def parities(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Of each text the parities of the hashes that fall on each of _BITS places, as words of 64; and of a set of over half as
    many hashes, those on the next power of two above twice its size. Words that are _BITS places apart add up to the former.
    """
    texts, least = len(bounds) - 1, _BITS // 64
    sizes = np.maximum(np.diff(bounds), 1)
    widths = np.maximum(_BITS, 2 ** (np.ceil(np.log2(sizes)).astype(np.int64) + 1))
    ends = np.append(0, np.cumsum(widths))
    wide = np.empty(ends[-1] // 64, np.int64)
    low = 0
    while low < texts:  # some at a time, as a parity is a number meanwhile
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + (1 << 20))) - 1)
        owner = np.repeat(np.arange(low, high), np.diff(bounds[low:high + 1]))
        places = mixed(hashes[bounds[low]:bounds[high]], 5).astype(np.int64) & (widths[owner] - 1)
        counts = np.bincount(places + ends[owner] - ends[low], minlength=ends[high] - ends[low])
        wide[ends[low] // 64:ends[high] // 64] = np.packbits((counts & 1).astype(np.uint8)).view(np.int64)
        low = high
    words = ends // 64
    folded = np.zeros((texts, least), np.int64)
    for word in range(least):
        single = np.flatnonzero(widths == _BITS)
        folded[single, word] = wide[words[single] + word]
    for i in np.flatnonzero(widths > _BITS):
        folded[i] = np.bitwise_xor.reduce(wide[words[i]:words[i + 1]].reshape(-1, least))
    large = widths > _BITS
    inside = np.repeat(large, np.diff(words))
    places = np.append(0, np.cumsum(np.where(large, np.diff(words), 0)))
    return folded, pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(wide[inside]))


def _sketch(rows: DataFrame, size: int, bits: int) -> np.ndarray:
    """Number of sets with a shingle in each of 2 ** `bits` cells: orders shingles by rareness."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_held()
        cells = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in slices(batch, _CHUNK):
                hashes, _ = shingle_sets(part.column(0), size)
                cells += np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=len(cells))
            settle()
        used = np.flatnonzero(cells)
        for at in range(0, len(used), 65536):
            some = used[at:at + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(cells[some])], names=["cell", "n"])

    found = rows.select("text").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    table = found.toArrow()  # one row for each cell at most
    cells = np.zeros(1 << bits, np.int64)
    cells[table["cell"].to_numpy()] = table["n"].to_numpy()
    return np.minimum(cells, 2**32 - 1).astype(np.uint32)


def _signed(rows: DataFrame, id_type: str, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """For each document: size of its set, two hashes of the set, one of its prefix, its bitmap, the prefix, and
    into how many parts the list of each of its shingles is cut (1 but for very common ones)."""
    excess = np.maximum(0, sketch.astype(np.int64) - 2 * int(sketch.mean()))
    parts = np.minimum(1 + excess // _LIST, 32767).astype(np.int16)
    shift = np.uint64(64 - int(np.log2(len(sketch))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, _CHUNK):
                hashes, bounds = shingle_sets(part.column(1), size)
                folded, wide = parities(hashes, bounds)
                counts = np.diff(bounds)
                owner = np.repeat(np.arange(len(counts)), counts)
                cells = (hashes >> shift).astype(np.int64)
                order = np.lexsort((hashes, sketch[cells], owner))
                lengths = np.where(counts > 0, counts - (counts * percent + 99) // 100 + 1, 0)
                inside = np.arange(len(order)) - bounds[owner] < lengths[owner]
                prefix = hashes[order][inside]
                ends = np.append(0, np.cumsum(lengths))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()),
                     pa.array(_sums(mixed(hashes, 2), bounds)), pa.array(_sums(mixed(hashes, 3), bounds)),
                     pa.array(_sums(mixed(prefix, 4), ends)),
                     pa.FixedSizeListArray.from_arrays(pa.array(folded.ravel()), _BITS // 64).cast(pa.list_(pa.int64())), wide,
                     _lists(prefix, ends),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(parts[cells[order][inside]]))],
                    names=["id", "n", "set_a", "set_b", "prefix_key", "bits", "wide", "prefix", "salts"])
            settle()

    return rows.select("id", "text").mapInArrow(
        work, f"id {id_type}, n bigint, set_a bigint, set_b bigint, prefix_key bigint,"
              " bits array<bigint>, wide array<bigint>, prefix array<bigint>, salts array<smallint>")


def _sets(rows: DataFrame, id_type: str, size: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, _CHUNK):
                hashes, bounds = shingle_sets(part.column(1), size)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(hashes, bounds)], names=["class", "hashes"])
            settle()

    return rows.select("id", "text").mapInArrow(work, f"class {id_type}, hashes array<bigint>")


def _broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """`df`, which has at most `rows` rows, sent to all tasks if these are no more than `most`."""
    return F.broadcast(df) if rows <= most else df


def _alike(percent: int, left: str, right: str) -> str:
    """Whether the bitmaps of two sets (n, bits) differ in no more places than sets with `percent` % in common may."""
    differ = " + ".join(f"bit_count({left}.bits[{i}] ^ {right}.bits[{i}])" for i in range(_BITS // 64))
    return f"{100 + percent} * ({differ}) <= {100 - percent} * ({left}.n + {right}.n)"


def _wide_alike(percent: int) -> str:
    """The same for the wide bitmaps of left_set and right_set; the longer one is folded until both have one length."""
    def folded(side: str, other: str) -> str:
        half = f"(size({side}.wide) div 2)"
        return (f"if(size({side}.wide) = 2 * size({other}.wide), zip_with(slice({side}.wide, 1, {half}),"
                f" slice({side}.wide, {half} + 1, {half}), (a, b) -> a ^ b), {side}.wide)")

    a, b = folded("left_set", "right_set"), folded("right_set", "left_set")
    differ = f"aggregate(zip_with({a}, {b}, (a, b) -> bit_count(a ^ b)), 0L, (sum, n) -> sum + coalesce(n, 0))"
    return (f"size(left_set.wide) = 0 or size(right_set.wide) = 0"
            f" or {100 + percent} * {differ} <= {100 - percent} * (left_set.n + right_set.n)")


def _filtered(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Those of `pairs` (left, right) whose bitmaps allow a link."""
    def side(name: str) -> DataFrame:
        return members.select(F.col("class").alias(name), F.struct("n", "bits", "wide").alias(f"{name}_set"))

    return (pairs.join(side("left"), "left").join(side("right"), "right")
            .where(_alike(percent, "left_set", "right_set")).where(_wide_alike(percent)).select("left", "right"))


def _verified(pairs: DataFrame, texts: DataFrame, id_type: str, size: int, percent: int, most: int) -> DataFrame:
    """Those of `pairs` (left, right) whose sets have at least `percent` % in common.

    Only the texts of documents in `pairs` are cut into shingles; the sets of the left ones travel
    once for each pair, those of the right ones once.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            lists = [batch.column(k) for k in (2, 3)]
            flat = [x.flatten().to_numpy() for x in lists]
            ends = [np.asarray(x.offsets) - x.offsets[0].as_py() for x in lists]
            for i in range(batch.num_rows):
                a, b = (f[e[i]:e[i + 1]] for f, e in zip(flat, ends))
                both = np.sort(np.concatenate([a, b]), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["left", "right"]) \
                .filter(pa.array(keep))
            settle()

    pairs = written(pairs, "ngram-pairs")
    count = pairs.count()

    def sets(side: str) -> DataFrame:
        ids = pairs.select(F.col(side).alias("id")).distinct()
        return _sets(texts.join(_broadcast(ids, count, most), "id", "left_semi"), id_type, size)

    left = sets("left").select(F.col("class").alias("left"), F.col("hashes").alias("a"))
    right = sets("right").select(F.col("class").alias("right"), F.col("hashes").alias("b"))
    both = left.join(_broadcast(pairs, count, most), "left").join(right, "right")
    return checkpointed(both.select("left", "right", "a", "b").mapInArrow(work, f"left {id_type}, right {id_type}"))


def _early(percent: int) -> str:
    """Whether two sets can have enough in common if the shingle at their places is the first common one."""
    return (f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
            f" and {100 + percent} * least(x.n - x.place, y.n - y.place) >= {percent} * (x.n + y.n)")


def _possible(entries: DataFrame, percent: int) -> DataFrame:
    """The different pairs of `entries` (x, y: class, n, place in a common list) to verify.

    The first common shingle of two sets must lie so early in both that enough remains from there.
    """
    return (entries.where("x.class <> y.class").where(_early(percent))
            .select(F.least("x.class", "y.class").alias("left"), F.greatest("x.class", "y.class").alias("right"))
            .distinct())


def _by_number(rows: DataFrame, id_column: str, text_column: str, options: dict) -> DataFrame:
    """The join of `rows` by the number of each row, brought back to ids."""
    number = F.when(F.col(id_column).isNotNull(), F.monotonically_increasing_id()).alias("number")
    numbered = written(rows.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), number), "ngram-numbered")
    found = written(jaccard_join(numbered, "number", "text", **options), "ngram-by-number")
    known = found.where("number is not null").join(numbered.select("number", "id"), "number")
    smallest = known.groupBy("component_id").agg(F.min("id").alias("smallest"))
    named = known.join(smallest, "component_id").select(F.col("id").alias(id_column), "n_shingles", F.col("smallest").alias("component_id"))
    none = F.lit(None).cast(rows.schema[id_column].dataType)
    return named.unionByName(found.where("number is null").select(none.alias(id_column), "n_shingles", none.alias("component_id")))


def jaccard_join(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, size: int = 5,
                 percent: int = 80, sketch_bits: int = 18, most_broadcast: int = 2_000_000) -> DataFrame:
    """One row for each row of `rows`: its id, n_shingles, component_id.

    A set are the distinct shingles of `size` words (white space cuts words, A-Z are lower-cased);
    a text with fewer words is one shingle. Documents are linked when their sets have at least
    `percent` % in common, and component_id is the smallest id that links reach. Texts that are null
    or without words have no shingles and are components of their own. A row with a null id is its own
    component (null). Repeated rows are linked like any equal texts, and so are rows that share an id but not a text, each by its
    own text. An empty table gives an empty result; other columns are ignored.

    `sketch_bits` bounds the table that orders shingles (it changes the work, never the result). Ids
    and pairs to verify are broadcast up to `most_broadcast` rows; beyond, they are joined by shuffle.
    """
    options = {"size": size, "percent": percent, "sketch_bits": sketch_bits, "most_broadcast": most_broadcast}
    id_type = rows.schema[id_column].dataType.simpleString()
    small_batches(rows.sparkSession)
    texts = rows.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    signed = written(_signed(texts, id_type, size, percent, _sketch(texts, size, sketch_bits)), "ngram-signed")
    keys = ["n", "prefix_key", "set_a", "set_b"]
    # Texts without shingles link with nothing, but are texts of their id as well.
    shared = signed.where("id is not null").select("id", *keys).groupBy("id").agg(
        *(F.min(c).alias(f"low_{c}") for c in keys), *(F.max(c).alias(f"high_{c}") for c in keys))
    if not shared.where(" or ".join(f"low_{c} <> high_{c}" for c in keys)).isEmpty():
        return _by_number(rows, id_column, text_column, options)
    found = signed.where("n > 0 and id is not null").groupBy(*keys).agg(F.min("id").alias("class"), F.first("bits").alias("bits"), F.first("wide").alias("wide"))
    groups = found.groupBy("n", "prefix_key").agg(F.min("class").alias("group"))
    classes = written(found.join(groups, ["n", "prefix_key"]), "ngram-classes")
    members = classes.select("class", "group", "n", "bits", "wide")

    others = written(signed.where("n > 0").select("id", "n", "prefix_key").join(
        groups.withColumnRenamed("group", "id"), ["id", "n", "prefix_key"], "left_anti").select("id", "n").distinct(),
        "ngram-others")  # all but the one document of each group that stands for it
    others = _broadcast(others, others.count(), most_broadcast)
    links = _passes(signed.join(others, ["id", "n"], "left_anti"), members, texts, id_type, options)
    found = components(links).withColumnRenamed("node", "class")
    by_set = classes.join(found, "class", "left").select(*keys, F.coalesce("component", "class").alias("component"))
    return (signed.select("id", *keys).join(by_set, keys, "left")
            .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))


def _list_entries(leaders: DataFrame) -> DataFrame:
    """The prefix shingles of each group with the groups beside it in the shingle's list, ordered within it.

    Three numbers of each entry are shuffled: place and, if the list is cut, its part; group; shingle, changed by the part.
    """
    salt = F.pmod(F.xxhash64("group"), F.col("entry.salts")).cast("bigint")
    packed = F.shiftleft(salt, 32).bitwiseOR(F.shiftleft((F.col("entry.salts") > 1).cast("bigint"), 31)).bitwiseOR(F.col("place").cast("bigint"))
    dealt = (leaders.where("n > 0")
             .select(F.col("id").alias("group"), F.posexplode(F.arrays_zip("prefix", "salts")).alias("place", "entry"))
             .select(packed.alias("packed"), "group", F.col("entry.prefix").bitwiseXOR(salt * F.lit(_SALTED)).alias("list"))
             .repartition("list"))
    unpacked = dealt.select(
        "list", "group", F.col("packed").bitwiseAND(F.lit(2**31 - 1)).alias("place"), F.expr("(packed & 2147483648) <> 0").alias("cut"),
        F.col("list").bitwiseXOR(F.shiftright("packed", 32) * F.lit(_SALTED)).alias("token"))
    # Neighbours differ from list to list, else a document meets the same few in all its lists.
    in_list = Window.partitionBy("list").orderBy(F.xxhash64(F.col("token") % 3, "group"), "group")
    return (unpacked.withColumn("before", F.lag(F.struct(F.col("group").alias("class"), "place")).over(in_list))
            .withColumn("after", F.lead("group").over(in_list))
            .withColumn("second", F.coalesce(F.lag("group", 2).over(in_list), F.lead("group", 2).over(in_list))))


def _passes(leaders: DataFrame, members: DataFrame, texts: DataFrame, id_type: str, options: dict) -> DataFrame:
    """Enough links between `members` (class, group, n, bits, wide) that all linked ones are connected; `leaders` have the prefixes."""
    size, percent, most_broadcast = (options[c] for c in ("size", "percent", "most_broadcast"))
    lists = _list_entries(leaders)
    crowded = members.where("class <> group").select(F.col("group").alias("crowd")).distinct()
    # A list of two groups of one class each is done with after the first pass, unless it was cut.
    lonely = "not cut and second is null and (before is null or after is null)"
    shared = written(
        lists.join(crowded, F.col("group") == F.col("crowd"), "left")
        .where("before is not null or after is not null or cut or (crowd is not null and place = 0)")
        .withColumn("lonely", F.expr(f"{lonely} and crowd is null")).drop("crowd")
        .join(crowded, F.coalesce("before.class", "after") == F.col("crowd"), "left")
        .select("token", "group", "place", "before", F.expr("lonely and crowd is null").alias("lonely")),
        "ngram-lists")
    sizes = members.where("class = group").select("group", "n")

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, texts, id_type, size, percent, most_broadcast)

    inside = members.where("class <> group").select(F.col("group").alias("left"), F.col("class").alias("right"))
    neighbours = (shared.where("before is not null").join(sizes, "group")
                  .join(sizes.select(F.col("group").alias("earlier"), F.col("n").alias("earlier_n")), F.col("before.class") == F.col("earlier"))
                  .select(F.struct(F.col("group").alias("class"), "n", "place").alias("x"),
                          F.struct("before.class", F.col("earlier_n").alias("n"), "before.place").alias("y")))
    links = verified(_filtered(_possible(neighbours, percent).unionByName(inside).distinct(), members, percent))
    entries = shared.where("not lonely").select("token", "group", "place").join(members.select("group", "class", "n"), "group").select(
        "token", F.struct("class", "n", "place").alias("entry"))

    def labelled(links: DataFrame) -> DataFrame:
        """Lists of shingles that more than one component has, with the component of each entry."""
        found = components(links)
        placed = (entries.join(found, F.col("entry.class") == F.col("node"), "left")
                  .select("token", "entry", F.coalesce("component", "entry.class").alias("component")))
        several = placed.groupBy("token").agg(
            F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
        return written(placed.join(several, "token", "left_semi"), "ngram-mixed")

    one = labelled(links).groupBy("token", "component").agg(
        F.min_by("entry", F.struct("entry.n", "entry.class")).alias("x"))
    in_list = Window.partitionBy("token").orderBy("x.n", "x.class")
    beside = _possible(one.withColumn("y", F.lag("x").over(in_list)).where("y is not null").select("x", "y"), percent)
    links = links.unionByName(verified(_filtered(beside, members, percent)))

    rest = labelled(links)
    largest = (rest.groupBy("token", "component").count().groupBy("token")
               .agg(F.max_by("component", F.struct("count", "component")).alias("largest"),
                    F.ceil(F.sum("count") / _PART).cast("int").alias("parts")))
    bits = members.select("class", "bits")
    placed = rest.join(bits, rest["entry.class"] == bits["class"]).join(largest, "token").select(
        "token", F.struct("entry.class", "entry.n", "entry.place", "bits").alias("x"), F.col("component").alias("of_x"),
        (F.col("component") == F.col("largest")).alias("in_largest"), "parts")
    # A long list is cut on one side, and the other side goes to each part; only the longest have more than one.
    small = placed.where("not in_largest").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("a")
    every = placed.select("token", F.pmod(F.xxhash64("x.class"), F.col("parts")).cast("int").alias("part"), F.col("x").alias("y"),
                          F.col("of_x").alias("of_y"), "in_largest").alias("b")
    # All of it is a condition of the join, so that only pairs to verify come out of it.
    wanted = F.expr(f"a.token = b.token and a.part = b.part and a.of_x <> b.of_y and (b.in_largest or a.x.class < b.y.class)"
                    f" and {_early(percent)} and {_alike(percent, 'x', 'y')}")
    across = small.join(every, wanted).select("x", "y")
    return links.unionByName(verified(_filtered(_possible(across, percent), members, percent)))
