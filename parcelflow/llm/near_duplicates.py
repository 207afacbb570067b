"""Near-duplicate documents by weighted MinHash over word shingles.

The bag of five-word shingles of a text is signed by Poisson processes over its
discretised weights, bands of the signature propose candidates, and candidates
are verified by the exact overlap of their bags.

Equal word sequences form one class first; only classes are compared. Within a
band bucket every class is compared with one pivot, the class that shares most
bands with others; that is linear in the size of the bucket and connects nearly
all that can be. Classes of a bucket that still are in different components are
compared in tiles: a task counts the shared shingles of two blocks of them at
once and gives only links that connect. So no pair is left out that a band
proposes, and no pairs are listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, free_name, text_bytes
from parcelflow.llm.wordhash import mix, word_hashes
from parcelflow.session import new_work_dir

#: Words of a shingle.
SHINGLE = 5
#: Least overlap of two bags: shared shingles by all shingles, each with its count.
SIMILAR = 0.8
#: Bands and places of a band. A pair at ``SIMILAR`` shares no band with a probability of 7e-6.
BANDS, PLACES = 30, 5
#: Partners of a pivot that are verified by one task.
PARTNERS = 256
#: Classes and bytes of bags in a block of a tile.
BLOCK_CLASSES, BLOCK_BYTES = 1024, 4 << 20

_TURNS = np.random.default_rng(5).integers(1, 1 << 63, (2, 64), dtype=np.uint64) | np.uint64(1)


def shingle_bag(words: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their counts; a shorter text with words is one shingle."""
    if len(words) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = max(1, len(words) - size + 1)
    sums = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        sums += words[k : k + n] * _TURNS[0, k]
    return np.unique(mix(sums), return_counts=True)


def _nth(n: int, turn: int) -> np.uint64:
    return np.uint64(n * int(_TURNS[1, turn]) % (1 << 64))


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Values in (0, 1] from 64-bit hashes."""
    return ((bits >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53


def signatures(shingles: np.ndarray, counts: np.ndarray, bag: np.ndarray, bags: int, size: int = BANDS * PLACES) -> np.ndarray:
    """A row of ``size`` places for each bag; a place is equal in two bags with a probability of their overlap.

    ``bag`` numbers the bag of each distinct shingle; every bag holds one at least.
    The weight of a shingle is cut into the intervals (0,1], (1,2], (2,4], (4,8]
    and so on. Each interval has a Poisson process of points as dense as it is
    long, seeded by shingle and interval alone. A point falls on one place of the
    signature and on a position in its interval; beyond the weight it does not
    count. A place keeps its first point. Only points before a time by which all
    places are likely taken are made; bags with a free place get twice that time.
    """
    ends = size * (np.log(size) + 6) / np.bincount(bag, counts, bags)
    kept = np.zeros(bags * size, np.uint64)
    todo = np.arange(bags)
    while len(todo):
        mine = np.isin(bag, todo)
        first = np.full(bags * size, np.inf)
        seed, of, low, rate, most = _intervals(shingles[mine], bag[mine], counts[mine])
        time, step = np.zeros(len(seed)), 0
        while len(seed):
            bits = mix(seed + _nth(step + 1, 1))
            time = time - np.log(_uniform(bits)) / rate
            on = time <= ends[of]
            seed, of, low, rate, most, time, bits = (x[on] for x in (seed, of, low, rate, most, time, bits))
            more = mix(bits ^ _TURNS[1, 2])
            inside = low + np.ceil(rate * _uniform(mix(more))) <= most
            place = of[inside] * size + ((more[inside] >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(first, place, time[inside])
            won = time[inside] == first[place]
            kept[place[won]] = bits[inside][won]
            step += 1
        todo = todo[~np.isfinite(first.reshape(bags, size)[todo]).all(axis=1)]
        ends[todo] *= 2
    return kept.reshape(bags, size)


def _intervals(shingles: np.ndarray, bag: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Seed, bag, lower end, length and weight of every interval that a weight reaches into."""
    found = [(shingles, bag, np.zeros(len(bag)), np.ones(len(bag)), counts)]
    level, above = 1, 1
    while (on := counts > above).any():
        shingles, bag, counts = shingles[on], bag[on], counts[on]
        ends = np.full(len(bag), float(above))
        found.append((mix(shingles + _nth(level, 0)), bag, ends, ends, counts))
        level, above = level + 1, 2 * above
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def band_hashes(places: np.ndarray) -> np.ndarray:
    """One signed 64-bit value for each band of each row, different for different bands."""
    bands = places.reshape(-1, BANDS, PLACES) * _TURNS[0, :PLACES]
    return mix(bands.sum(axis=2, dtype=np.uint64) + _TURNS[0, 8 : 8 + BANDS]).view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted overlap of two bags: sum of lesser counts by sum of larger counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def _sequence_key(words: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.int64).tolist())


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text"):
        data, at = text_bytes(batch.column("text"))
        words = [word_hashes(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        bags = [shingle_bag(w) for w in words]
        full = [k for k, w in enumerate(words) if len(w)]
        bands: list = [None] * len(words)
        if full:
            bag = np.repeat(np.arange(len(full)), [len(bags[k][0]) for k in full])
            signed = signatures(np.concatenate([bags[k][0] for k in full]), np.concatenate([bags[k][1] for k in full]), bag, len(full))
            for k, row in zip(full, band_hashes(signed), strict=True):
                bands[k] = row
        keys = [_sequence_key(w) if len(w) else (None, None) for w in words]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array([a for a, _ in keys], pa.int64()),
                pa.array([b for _, b in keys], pa.int64()),
                pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "text_hash", "key_a", "key_b", "n_shingles", "bands"],
        )


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, and lost executors cost nothing."""
    folder = new_work_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _bags(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """class_id, shingles, counts of the wanted classes, from one document of each."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            data, at = text_bytes(batch.column("text"))
            bags = [shingle_bag(word_hashes(data[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id"), pa.array([s.tobytes() for s, _ in bags], pa.binary()), pa.array([c.astype("<u4").tobytes() for _, c in bags], pa.binary())],
                ["class_id", "shingles", "counts"],
            )

    texts = docs.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    of = wanted.select("class_id", F.coalesce("first_doc", F.lit(0)).alias("_id"), F.col("first_hash").alias("_hash"))
    return texts.join(of, ["_id", "_hash"]).select("class_id", "text").mapInArrow(bag, "class_id long, shingles binary, counts binary").dropDuplicates(["class_id"])


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (pivot, partner) whose bags overlap enough.

    Bags are dealt by pivot, a pivot with many partners over several tasks, each
    of which reads the pivot's bag first and then streams its partners.
    """
    fans = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("_fans"))
    partners = (
        pairs.join(fans, "pivot")
        .withColumn("_fan", F.pmod(F.xxhash64("partner"), F.col("_fans")).cast("int"))
        .join(bags.withColumnRenamed("class_id", "partner"), "partner")
        .select("pivot", "_fan", "partner", "shingles", "counts")
    )
    pivots = (
        fans.withColumn("_fan", F.explode(F.sequence(F.lit(0), F.col("_fans") - 1)))
        .join(bags.withColumnRenamed("class_id", "pivot"), "pivot")
        .select("pivot", "_fan", F.lit(None).cast("long").alias("partner"), "shingles", "counts")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bag = None
        for batch in batches:
            found = []
            columns = (batch.column(c) for c in ("pivot", "partner", "shingles", "counts"))
            for pivot, partner, shingles, counts in zip(*columns, strict=True):
                here = np.frombuffer(shingles.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64)
                if not partner.is_valid:
                    bag = here
                elif overlap(bag, here) >= SIMILAR:
                    found.append((pivot.as_py(), partner.as_py()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["pivot", "partner"])

    dealt = pivots.unionByName(partners).repartition("pivot", "_fan")
    return dealt.sortWithinPartitions("pivot", "_fan", F.col("partner").asc_nulls_first()).mapInArrow(verify, "pivot long, partner long")


def shared_counts(left: list, right: list) -> np.ndarray:
    """How many shingles, with their counts, each bag on the left shares with each on the right.

    The n-th occurrence of a shingle counts as an element of its own. Elements in
    many bags of both sides are counted by a matrix product, the others one by one.
    """
    sides = []
    for bags in (left, right):
        elements = [mix(np.repeat(s, c) + _places(c) * _TURNS[1, 3]) for s, c in bags]
        sides.append((np.concatenate(elements), np.repeat(np.arange(len(bags)), [len(e) for e in elements])))
    (a, of_a), (b, of_b) = sides
    both = np.intersect1d(a, b)
    rows = []
    for elements, of in sides:
        at = np.searchsorted(both, elements).clip(max=max(0, len(both) - 1))
        on = both[at] == elements if len(both) else np.zeros(len(at), bool)
        order = np.argsort(at[on], kind="stable")
        rows.append((at[on][order], of[on][order]))
    (at_a, of_a), (at_b, of_b) = rows
    n_a, n_b = np.bincount(at_a, minlength=len(both)), np.bincount(at_b, minlength=len(both))
    out = np.zeros((len(left), len(right)))
    frequent = n_a * n_b * 150 > len(left) * len(right)
    often = np.flatnonzero(frequent)
    for k in range(0, len(often), 2048):
        some = np.full(len(both), -1)
        some[often[k : k + 2048]] = np.arange(len(often[k : k + 2048]))
        x, y = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
        for matrix, at, of in ((x, at_a, of_a), (y, at_b, of_b)):
            on = some[at] >= 0
            matrix[of[on], some[at[on]]] = 1
        out += x @ y.T
    first_a, first_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
    rare = np.flatnonzero(~frequent)
    ends = np.searchsorted(np.cumsum((n_a * n_b)[rare]), np.arange(0, (n_a * n_b)[rare].sum() + (1 << 20), 1 << 20))
    for low, high in zip(ends[:-1], ends[1:], strict=True):
        some = rare[low:high]
        times = n_a[some] * n_b[some]
        place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        i, j = np.divmod(place, np.repeat(n_b[some], times))
        pair = of_a[np.repeat(first_a[some], times) + i] * len(right) + of_b[np.repeat(first_b[some], times) + j]
        out += np.bincount(pair, minlength=out.size).reshape(out.shape)
    return out


def _places(counts: np.ndarray) -> np.ndarray:
    """0 to count - 1 for every count, end to end."""
    return (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)


def _connecting(rows: list[tuple], halves: tuple[list[int], list[int]]) -> list[tuple[int, int]]:
    """Links between similar rows (class, label, bag) of the two halves of a tile, as few as connect all they connect."""
    root = {label: label for _, label, _ in rows}

    def top(label: int) -> int:
        while root[label] != label:
            label = root[label] = root[root[label]]
        return label

    left, right = halves
    shared = shared_counts([rows[k][2] for k in left], [rows[k][2] for k in right])
    sizes = np.array([float(bag[1].sum()) for _, _, bag in rows])
    total = sizes[left][:, None] + sizes[right] - shared
    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(shared >= SIMILAR * total - 1e-9)), strict=True):
        a, b = rows[left[i]], rows[right[j]]
        if top(a[1]) != top(b[1]) and overlap(a[2], b[2]) >= SIMILAR:
            root[top(a[1])] = top(b[1])
            found.append((a[0], b[0]))
    return found


def _links_apart(apart: DataFrame, bags: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links (pivot, partner) between classes of one band that are in different components.

    ``apart`` has band, class_id, label and whether the label is the band's main
    one. The others form blocks of bounded size, and so do those of the main
    label; each block of the others meets each block once.
    """
    sized = apart.join(sizes, "class_id").withColumn("_bytes", F.col("n_shingles") * 12)
    blocks = lambda few: F.greatest(
        F.ceil(F.count_if(F.col("main") != few) / BLOCK_CLASSES), F.ceil(F.sum(F.when(F.col("main") != few, F.col("_bytes")).otherwise(0)) / BLOCK_BYTES)
    ).cast("int")
    fans = sized.groupBy("band").agg(blocks(True).alias("_few"), blocks(False).alias("_main"))
    own = F.pmod(F.xxhash64("class_id"), F.when(F.col("main"), F.col("_main")).otherwise(F.col("_few"))).cast("int")
    tile = lambda kind, a, b, half: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), half.alias("half"))
    few, main = (F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>")) for n in ("_few", "_main"))
    among = F.transform(few, lambda j: tile(0, F.least("_own", j), F.greatest("_own", j), F.when(F.col("_own") == j, 2).when(F.col("_own") < j, 0).otherwise(1)))
    across = F.transform(main, lambda j: tile(1, F.col("_own"), j, F.lit(0)))
    mains = F.transform(few, lambda i: tile(1, i, F.col("_own"), F.lit(1)))
    dealt = (
        sized.join(fans, "band")
        .withColumn("_own", own)
        .select("band", "class_id", "label", F.explode(F.when(F.col("main"), mains).otherwise(F.concat(among, across))).alias("tile"))
        .select("band", "class_id", "label", "tile.*")
        .join(bags, "class_id")
        .repartition("band", "kind", "a", "b")
        .sortWithinPartitions("band", "kind", "a", "b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, halves = None, [], ([], [])

        def links() -> pa.RecordBatch:
            found = _connecting(rows, halves) if all(halves) else []
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["pivot", "partner"])

        for batch in batches:
            plain = (batch.column(c).to_pylist() for c in ("band", "kind", "a", "b", "half", "class_id", "label"))
            for *key, half, class_id, label, shingles, counts in zip(*plain, batch.column("shingles"), batch.column("counts"), strict=True):
                if key != held:
                    if held is not None:
                        yield links()
                    held, rows, halves = key, [], ([], [])
                for side in (0, 1) if half == 2 else (half,):
                    halves[side].append(len(rows))
                rows.append((class_id, label, (np.frombuffer(shingles.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))))
        if held is not None:
            yield links()

    return dealt.select("band", "kind", "a", "b", "half", "class_id", "label", "shingles", "counts").mapInArrow(compare, "pivot long, partner long")


def components(links: DataFrame) -> DataFrame:
    """id, label for every linked id: the least id it is connected with.

    Labels flow over links and are then followed one step further, round by
    round, until none changes; each round is stored in the shared folder.
    """
    both = _stored(links.select(F.col("pivot").alias("id"), F.col("partner").alias("to")).unionByName(links.select(F.col("partner").alias("id"), F.col("pivot").alias("to"))), "links")
    labels = _stored(both.groupBy("id").agg(F.least(F.min("to"), F.first("id")).alias("label")), "labels")
    total = None
    while True:
        found = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if found == total or found is None:
            return labels
        total = found
        flown = both.join(labels.select(F.col("id").alias("to"), F.col("label").alias("_label")), "to").groupBy("id").agg(F.min("_label").alias("_label"))
        least = labels.join(flown, "id").select("id", F.least("label", "_label").alias("label"))
        known = labels.select(F.col("id").alias("label"), F.col("label").alias("_next"))
        labels = _stored(least.join(known, "label", "left").select("id", F.least("label", F.coalesce("_next", "label")).alias("label")), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, class_doc, n_copies, n_verified, group_id, group_doc, group_size.

    ``class_doc`` is the least doc_id of the rows with the same words in the same
    order, ``group_doc`` that of all rows connected by links between similar
    texts, which share a ``group_id``; ``n_copies`` and ``group_size`` count those rows. ``n_verified`` counts
    the links of the row's class that were verified to connect its group, which
    is not all it has: pairs already connected are not verified again. A row whose text is null or
    has no word stands alone, with its own doc_id and no group_id. Repeated rows are copies of
    each other. Null doc_ids sort last. An empty table gives no rows. Other
    columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = _stored(
        rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_signed, "doc_id long, text_hash long, key_a long, key_b long, n_shingles long, bands array<long>"), "signed"
    )
    worded = signed.where("key_a is not null")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    classes = _stored(
        worded.groupBy("key_a", "key_b")
        .agg(F.min(order).alias("_first"), F.count("*").alias("n_copies"), F.max("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
        .select(F.monotonically_increasing_id().alias("class_id"), "key_a", "key_b", "n_copies", "n_shingles", "bands", F.col("_first.doc_id").alias("first_doc"), F.col("_first.text_hash").alias("first_hash")),
        "classes",
    )
    exploded = classes.select("class_id", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count("*").alias("_n")).where("_n > 1")
    members = _stored(exploded.join(shared, "band"), "members")
    central = members.groupBy("class_id").agg(F.sum("_n").alias("_central"))
    pivots = members.join(central, "class_id").groupBy("band").agg(F.max_by("class_id", F.struct("_central", -F.col("class_id"))).alias("pivot"))
    members = _stored(members.join(pivots, "band").select("band", "class_id", "pivot"), "members")
    sizes = classes.select("class_id", "n_shingles")

    def near_in_size(pairs: DataFrame) -> DataFrame:
        sized = pairs.join(sizes.select(F.col("class_id").alias("pivot"), F.col("n_shingles").alias("_a")), "pivot").join(sizes.select(F.col("class_id").alias("partner"), F.col("n_shingles").alias("_b")), "partner")
        return sized.where(F.least("_a", "_b") >= F.greatest("_a", "_b") * SIMILAR).select("pivot", "partner")

    first_pairs = _stored(near_in_size(members.where("class_id != pivot").select("pivot", F.col("class_id").alias("partner")).distinct()), "pairs")
    needed = members.select("class_id").distinct().join(classes.select("class_id", "first_doc", "first_hash"), "class_id")
    bags = _stored(_bags(rows, needed), "bags")
    links = _stored(_verified(first_pairs, bags), "verified")
    labels = components(links)

    placed = _stored(members.join(labels.withColumnRenamed("id", "class_id"), "class_id", "left").withColumn("label", F.coalesce("label", "class_id")), "placed")
    by_label = placed.groupBy("band", "label").agg(F.count("*").alias("_n"))
    main = by_label.groupBy("band").agg(F.count("*").alias("_labels"), F.max_by("label", F.struct("_n", "label")).alias("_main")).where("_labels > 1")
    apart = placed.where("class_id != pivot").join(main, "band").select("band", "class_id", "label", (F.col("label") == F.col("_main")).alias("main"))
    more = _stored(_links_apart(apart, bags, sizes), "verified")
    links = _stored(links.unionByName(more).distinct(), "links")
    labels = components(links)

    degree = links.select(F.col("pivot").alias("class_id")).unionByName(links.select(F.col("partner").alias("class_id"))).groupBy("class_id").agg(F.count("*").alias("n_verified"))
    labelled = (
        classes.join(labels.withColumnRenamed("id", "class_id"), "class_id", "left")
        .join(degree, "class_id", "left")
        .select("key_a", "key_b", "n_copies", "first_doc", F.coalesce("label", "class_id").alias("label"), F.coalesce("n_verified", F.lit(0).cast("long")).alias("n_verified"))
    )
    groups = labelled.groupBy("label").agg(F.min("first_doc").alias("group_doc"), F.sum("n_copies").alias("group_size"))
    known = _stored(labelled.join(groups, "label").select("key_a", "key_b", F.col("first_doc").alias("class_doc"), "n_copies", "n_verified", F.col("label").alias("group_id"), "group_doc", "group_size"), "groups")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = [F.col("doc_id"), one, none, F.lit(None).cast("long"), F.col("doc_id"), one]
    names = ["class_doc", "n_copies", "n_verified", "group_id", "group_doc", "group_size"]
    return signed.join(known, ["key_a", "key_b"], "left").select(
        "doc_id", "text_hash", *(F.when(F.col("key_a").isNull(), a).otherwise(F.col(n)).alias(n) for n, a in zip(names, alone, strict=True))
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the row with the least doc_id, one if that is repeated.

    Rows that stand alone all stay. Columns and their types are those of ``docs``.
    """
    found = near_duplicates(docs)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    stays = _stored(
        found.groupBy("group_id", "doc_id", "text_hash")
        .agg(F.count("*").alias("_rows"))
        .groupBy("group_id", F.when(F.col("group_id").isNull(), F.struct("doc_id", "text_hash")).alias("_alone"))
        .agg(F.min(F.struct(first.alias("_first"), "_rows")).alias("_least"))
        .select(
            F.col("_least._first.doc_id").alias("_doc"),
            F.col("_least._first.text_hash").alias("_hash"),
            (F.col("group_id").isNotNull() & (F.col("_least._rows") > 1)).alias("_repeated"),
        ),
        "stays",
    )
    own, doc, digest, repeated = (free_name(docs, n) for n in ("_text_hash", "_doc", "_hash", "_repeated"))
    stays = stays.toDF(doc, digest, repeated)
    kept = docs.withColumn(own, F.xxhash64("text")).join(stays, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(digest)))
    if stays.where(F.col(repeated)).isEmpty():
        return kept.select(docs.columns)
    once = kept.where(F.col(repeated)).dropDuplicates([doc, digest])
    return kept.where(~F.col(repeated)).unionByName(once).select(docs.columns)
