"""Near-duplicate documents by BagMinHash over weighted word shingles.

A document is a bag of ``SHINGLE``-word shingles with their counts. Counts are discretised to
unit levels, grouped in blocks [0,1), [1,2), [2,4), [4,8) ...; every (shingle, block) carries a
Poisson process whose points fall on a time, a register and a level of the block. A point
counts if its level is below the shingle's count, so two bags share exactly the points of
their common part, and the earliest point of a register is shared with a probability equal to
their weighted Jaccard similarity. Points are made in order of time and only up to the time
by which all registers of a document are filled.

Bands of registers give buckets of alike bags. In each bucket every member is compared with the
bucket's first. Members that this leaves in different classes are joined once more, by the rarest of their
shingles, which finds every alike pair across classes without forming the pairs of a bucket. The
comparison is the exact multiset overlap of the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import LAST_ID, SPACED, Sequences, Words, given_id, mixed, own_id, pieces, signed, slices, stored

SHINGLE = 5
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: Cells of the table in which rarity is counted.
RARITY = 1 << 16
#: Columns of a sketch, 64 bits each.
SKETCH = [f"_bits{i}" for i in range(16)]
#: Rarest met elements of a text by which a pair is told to have met before.
LEAD = 16
#: Members of one group that are verified in one task at a time.
LOT = 256


def bags(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of every text; a text of fewer words than a shingle is one shingle."""
    n = np.diff(words.first)
    at = np.arange(len(words))
    end = np.minimum(at + SHINGLE, words.first[words.row + 1])
    keep = (end - at == SHINGLE) | (at == words.first[words.row]) & (n[words.row] < SHINGLE)
    at, end = at[keep], end[keep]
    row, shingle = words.row[at], Sequences(words.hashes).of(at, end)
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])])) if len(row) else np.zeros(0, np.int64)
    return row[new], shingle[new], np.diff(np.append(new, len(row)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def signatures(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
    """``rows`` x REGISTERS signatures; rows without shingles have the largest value throughout."""
    block_row, block_seed, low, width, weight = [], [], [], [], []
    level = 0
    live = np.arange(len(row))
    while len(live):
        begin = 0 if level == 0 else 1 << (level - 1)
        live = live[count[live] > begin]
        block_row.append(row[live])
        block_seed.append(mixed(shingle[live], 100 + level))
        low.append(np.full(len(live), begin))
        width.append(np.full(len(live), max(1, begin)))
        weight.append(count[live])
        level += 1
    block_row, block_seed, low, width, weight = (np.concatenate(c) for c in (block_row, block_seed, low, width, weight)) if block_row else [row] * 5
    time = np.full(rows * REGISTERS, np.inf)
    value = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    total = np.bincount(row, weights=count, minlength=rows)
    limit = REGISTERS * (np.log(REGISTERS) + 3.0)  # points of a text until its registers are mostly filled
    alive = np.arange(len(block_row))  # blocks whose next point may still come before the limit
    clock = np.zeros(len(block_row))
    turn = np.zeros(len(block_row), np.uint64)
    pending = np.zeros(len(block_row))
    pending[:] = -np.log(_uniform(mixed(block_seed, 1))) / width if len(block_row) else 0
    while len(alive):
        bound = limit / np.maximum(total, 1)
        now = alive
        while len(now):
            due = clock[now] + pending[now] <= bound[block_row[now]]
            now = now[due]
            if not len(now):
                break
            clock[now] += pending[now]
            turn[now] += np.uint64(1)
            draw = mixed(block_seed[now] ^ (turn[now] << np.uint64(8)), 2)
            taken = low[now] + ((draw >> np.uint64(32)) % width[now].astype(np.uint64)).astype(np.int64) < weight[now]
            hit = now[taken]
            cell = block_row[hit] * REGISTERS + (draw[taken] % np.uint64(REGISTERS)).astype(np.int64)
            order = np.argsort(-clock[hit], kind="stable")  # the earliest is written last
            cell, hit_time, hit_value = cell[order], clock[hit][order], mixed(draw[taken][order], 3)
            better = hit_time < time[cell]
            cell, hit_time, hit_value = cell[better], hit_time[better], hit_value[better]
            time[cell], value[cell] = hit_time, hit_value
            pending[now] = -np.log(_uniform(mixed(block_seed[now] ^ (turn[now] << np.uint64(8)), 1))) / width[now]
        open_rows = np.isinf(time.reshape(rows, REGISTERS)).any(axis=1)
        alive = alive[open_rows[block_row[alive]]]
        limit *= 2
    return value.reshape(rows, REGISTERS)


BUCKETS = "_bucket long, _node long, _size long"


def buckets(texts: DataFrame) -> DataFrame:
    """(_bucket, _node, _size) of every band of every text that has words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1_000_000):
            words = Words(batch.column("_text"), SPACED)
            row, shingle, count = bags(words)
            signature = signatures(row, shingle, count, batch.num_rows)
            size = np.bincount(row, weights=count, minlength=batch.num_rows).astype(np.int64)
            filled = np.flatnonzero(size)
            salted = [mixed(signature[filled, b * ROWS], b) for b in range(BANDS)]
            for b in range(BANDS):
                for r in range(1, ROWS):
                    salted[b] = mixed(salted[b] ^ signature[filled, b * ROWS + r], r)
            own = pa.array(np.tile(filled, BANDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate(salted))), batch.column("_node").take(own), pa.array(np.tile(size[filled], BANDS))],
                names=["_bucket", "_node", "_size"],
            )

    return texts.mapInArrow(each, BUCKETS)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags (sorted shingles, counts)."""
    at = np.searchsorted(a[0], b[0])
    at = np.minimum(at, len(a[0]) - 1)
    same = a[0][at] == b[0]
    common = np.minimum(a[1][at[same]], b[1][same]).sum()
    return common / (a[1].sum() + b[1].sum() - common)


def verified(texts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The (_a, _b) of ``pairs`` whose bags overlap enough.

    Each pair's second text goes to the group of its first. A large group is dealt in lots, each with a
    copy of the first text, so one task holds a lot and not a group.
    """
    lots = pairs.withColumn("_lot", F.pmod(F.xxhash64("_b"), F.greatest(F.ceil(F.col("_held") / LOT), F.lit(1))))
    roles = lots.select(F.col("_b").alias("_node"), "_a", "_lot", F.lit(True).alias("_member")).unionByName(
        lots.select(F.col("_a").alias("_node"), "_a", "_lot", F.lit(False).alias("_member")).distinct()
    )
    dealt = (
        texts.join(roles, "_node")
        .select("_a", "_lot", "_member", "_node", "_text")
        .repartition(pieces(texts.sparkSession), "_a", "_lot")
        .sortWithinPartitions("_a", "_lot", "_member")
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, bag = None, None
        for batch in slices(batches, "_text", 1_000_000):
            row, shingle, count = bags(Words(batch.column("_text"), SPACED))
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            out: list[tuple] = []
            for i, (a, lot, member, node) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                own = shingle[edge[i] : edge[i + 1]], count[edge[i] : edge[i + 1]]
                if not member:
                    head, bag = (a, lot), own
                    continue
                if head != (a, lot):
                    raise RuntimeError("a lot came without its first text")
                if overlap(bag, own) >= threshold:
                    out.append((a, node))
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["_a", "_b"])

    return dealt.mapInArrow(each, "_a long, _b long")


def classes(links: DataFrame) -> DataFrame:
    """(_node, _class): the least node of each connected component of stored ``links``.

    Every round gives each node the least label around it and then the label of that label, and
    ends when no label changes. Labels and links stay distributed; a count comes to the driver.
    """
    both = stored(links.select(F.col("_a").alias("_from"), F.col("_b").alias("_to")).union(links.select("_b", "_a")).distinct(), "class-links")
    labels = stored(both.groupBy(F.col("_from").alias("_node")).agg(F.min("_to").alias("_near")).select("_node", F.least("_node", "_near").alias("_class")), "class-labels")
    while True:
        near = both.join(labels, F.col("_to") == F.col("_node")).groupBy("_from").agg(F.min("_class").alias("_near"))
        lower = labels.join(near, F.col("_node") == F.col("_from")).select("_node", F.col("_class").alias("_old"), F.least("_class", "_near").alias("_class"))
        lower = stored(lower, "class-lower")
        jump = lower.select(F.col("_node").alias("_at"), F.col("_class").alias("_further"))
        labels = stored(
            lower.join(jump, F.col("_class") == F.col("_at")).select("_node", "_old", F.least("_class", "_further").alias("_class")), "class-labels"
        )
        if not labels.where("_class != _old").limit(1).count():
            return labels.select("_node", "_class")


def elements(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, element): the bags as sets, the second copy of a shingle being another element than the first."""
    row, shingle, count = bags(words)
    again = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(row, count), mixed(np.repeat(shingle, count) + again.astype(np.uint64), 31)


def across_classes(texts: DataFrame, threshold: float) -> DataFrame:
    """(_a, _b): the pairs of ``meetings``, once each."""
    return meetings(texts, threshold).distinct()


def meetings(texts: DataFrame, threshold: float) -> DataFrame:
    """(_a, _b): all pairs of ``texts`` (_node, _class, _size, _text) in different classes that may be alike.

    Two bags that overlap enough share an element among the first (1 - threshold) share of both, in any
    order of elements that both use. The order is by rarity, so what many texts have in common, as a
    passage in each of them, brings no pairs. Rarity is counted in a table of fixed size,
    which only affects how few pairs come out, never which alike pairs are among them. Sketches of 1,024
    bits bound what two texts can share, which rules out most edited copies of one text before they are compared.
    Two texts meet at the first element they share: where both name an earlier one among their first ``LEAD``, the pair
    has come out there and is not made again.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(RARITY, np.int64)
        for batch in slices(batches, "_text", 1_000_000):
            _, found = elements(Words(batch.column("_text"), SPACED))
            np.add.at(table, (found % np.uint64(RARITY)).astype(np.int64), 1)
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[used])], names=["_cell", "_seen"])

    seen = texts.select("_text").mapInArrow(counted, "_cell long, _seen long").groupBy("_cell").agg(F.sum("_seen").alias("_seen"))
    rarity = np.zeros(RARITY, np.int64)
    for cell, n in seen.collect():  # at most RARITY rows
        rarity[cell] = n
    shared = texts.sparkSession.sparkContext.broadcast(rarity)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1_000_000):
            row, found = elements(Words(batch.column("_text"), SPACED))
            often = shared.value[(found % np.uint64(RARITY)).astype(np.int64)]
            order = np.lexsort((found, often, row))
            row, found, often = row[order], found[order], often[order]
            size = np.bincount(row, minlength=batch.num_rows)
            place = np.arange(len(row)) - (np.cumsum(size) - size)[row]
            kept = (place < size[row] - np.ceil(threshold * size[row] - 1e-9) + 1) & (often > 1)
            own = row[kept]
            bits = np.zeros((batch.num_rows, 64 * len(SKETCH)), bool)
            bits[row, (found >> np.uint64(40)) % np.uint64(64 * len(SKETCH))] = True
            sketch = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            # a row without an element for each text, which holds its sketch, and a narrow row for each element
            for element, place, at, drawn in (
                (pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.int64()), np.arange(batch.num_rows), sketch),
                (pa.array(signed(found[kept])), pa.array(place[kept]), own, None),
            ):
                held = [pa.nulls(len(at), pa.int64()) if drawn is None else pa.array(drawn[:, i]) for i in range(len(SKETCH))]
                yield pa.RecordBatch.from_arrays(
                    [element, place, *[batch.column(c).take(pa.array(at)) for c in ("_node", "_class", "_size")], *held],
                    names=["_element", "_place", "_node", "_class", "_size", *SKETCH],
                )

    columns = ", ".join(f"{c} long" for c in ("_element", "_place", "_node", "_class", "_size", *SKETCH))
    rare = stored(texts.select("_node", "_class", "_size", "_text").mapInArrow(rarest, columns), "bag-rare")
    narrow = rare.where(F.col("_element").isNotNull()).select("_element", "_place", "_node", "_class")
    wanted = narrow.groupBy(F.col("_element").alias("_of")).agg(F.min("_class").alias("_x"), F.max("_class").alias("_y")).where("_x != _y").select("_of")
    met = stored(narrow.join(wanted, F.col("_element") == F.col("_of"), "left_semi").select("_element", "_place", "_node"), "bag-met")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_place", "_element"))), lambda x: x["_element"])
    lead = met.groupBy(F.col("_node").alias("_at")).agg(F.slice(ordered, 1, LEAD).alias("_lead"))
    heads = stored(
        rare.where(F.col("_element").isNull()).drop("_element", "_place").join(lead, F.col("_node") == F.col("_at")).drop("_at"), "bag-heads"
    )
    dealt = met.select("_element", F.col("_node").alias("_at")).join(heads, F.col("_node") == F.col("_at")).drop("_at")
    other = dealt.select(
        F.col("_element").alias("_shared"), F.col("_node").alias("_with"), F.col("_size").alias("_other"), F.col("_class").alias("_beyond"),
        F.col("_lead").alias("_lead_other"), *[F.col(c).alias(f"{c}_other") for c in SKETCH],
    )
    first = F.get(F.array_intersect("_lead", "_lead_other"), F.lit(0))
    # every bit that one text has set and the other has not is an element that they do not share
    apart = lambda a, b: sum((F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y)))) for x, y in zip(a, b)), F.lit(0))
    others = [f"{c}_other" for c in SKETCH]
    most = F.least(F.col("_size") - apart(SKETCH, others), F.col("_other") - apart(others, SKETCH))
    needed = threshold / (1 + threshold) * (F.col("_size") + F.col("_other")) - 1e-9
    return (
        dealt.join(other, F.col("_element") == F.col("_shared"))
        .where("_class < _beyond")
        .where((F.least("_size", "_other") >= threshold * F.greatest("_size", "_other")) & (most >= needed) & F.coalesce(first == F.col("_element"), F.lit(True)))
        .select(F.least("_node", "_with").alias("_a"), F.greatest("_node", "_with").alias("_b"))
    )


def class_members(docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: _id, _tx, _words, _head (least id and text hash of its class), _count.

    Classes are the connected components of equal texts and of texts whose weighted Jaccard similarity over
    five-word shingles is at least ``threshold``. Texts without words have no class: their _head is NULL.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(own_id(id_column).alias("_id"), F.xxhash64(text).alias("_node"), text.alias("_text"))
    held = stored(buckets(rows.select("_node", "_text")), "bag-buckets")
    shared = stored(
        held.groupBy(F.col("_bucket").alias("_of")).agg(F.min("_node").alias("_low"), F.max("_node").alias("_high"), F.count(F.lit(1)).alias("_crowd")).where("_low != _high"),
        "bag-shared",
    )
    alike = stored(
        held.join(shared, F.col("_bucket") == F.col("_of")).groupBy("_bucket", "_node").agg(F.first("_size").alias("_size"), F.first("_crowd").alias("_crowd")), "bag-alike"
    )
    # the text that most others resemble is in the most crowded buckets; it is the one to compare with
    fame = stored(alike.groupBy("_node").agg(F.sum("_crowd").alias("_fame")), "bag-fame")
    members = stored(alike.join(fame, "_node").select("_bucket", "_node", "_size", "_fame"), "bag-members")
    centre = members.groupBy(F.col("_bucket").alias("_of")).agg(F.max_by("_node", F.struct("_fame", "_node")).alias("_first"))
    texts = rows.select("_node", "_text").groupBy("_node").agg(F.first("_text").alias("_text"))

    def checked(pairs: DataFrame, purpose: str) -> DataFrame:
        sized = pairs.groupBy("_a").agg(F.count(F.lit(1)).alias("_held"))
        return stored(verified(texts, pairs.join(sized, "_a"), threshold), purpose)

    stars = stored(members.join(centre, F.col("_bucket") == F.col("_of")).where("_node != _first").select(F.col("_first").alias("_a"), F.col("_node").alias("_b")).distinct(), "bag-stars")
    links = checked(stars, "bag-links")
    found = classes(links)
    labelled = stored(
        members.join(found, "_node", "left").select("_bucket", "_node", "_size", F.coalesce("_class", "_node").alias("_class")), "bag-labelled"
    )
    mixed_buckets = labelled.groupBy("_bucket").agg(F.min("_class").alias("_x"), F.max("_class").alias("_y")).where("_x != _y").select("_bucket")
    apart = labelled.join(mixed_buckets, "_bucket").groupBy("_node", "_class").agg(F.first("_size").alias("_size"))
    rest = across_classes(stored(texts.join(apart, "_node"), "bag-apart"), threshold).join(stars, ["_a", "_b"], "left_anti")
    rest = stored(rest, "bag-rest")
    if rest.limit(1).count():
        found = classes(links.union(checked(rest, "bag-more")))
    has_words = F.length(F.trim(F.translate("_text", "\t\n\x0b\f\r", "     "))) > 0
    placed = rows.select("_id", "_node", has_words.alias("_words"))
    labels = stored(placed.join(found, "_node", "left").select("_id", "_node", "_words", F.coalesce("_class", "_node").alias("_class")), "bag-rows")
    heads = stored(
        labels.where("_words").groupBy("_class").agg(F.min(F.struct("_id", F.col("_node").alias("_tx"))).alias("_head"), F.count(F.lit(1)).alias("_count")), "bag-heads"
    )
    return labels.join(heads, "_class", "left").select(
        "_id", F.col("_node").alias("_tx"), "_words", F.when(F.col("_words"), F.col("_head")).alias("_head"), F.when(F.col("_words"), F.col("_count")).alias("_count")
    )


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), class_size.

    Classes as in ``class_members``; a pair at the threshold is found with a probability of 1 - 3e-6. Texts are
    known by a 64-bit hash. Texts without words, NULL among them, are classes of their own. The class_id of a
    class in which no document has an id is NULL. Repeated rows are members of one class. An
    empty table gives an empty result.
    """
    head = F.when(F.col("_head._id") != LAST_ID, F.col("_head._id"))
    return class_members(docs, threshold, id_column, text_column).select(
        given_id().alias("doc_id"),
        F.when(F.col("_words"), head).otherwise(given_id()).alias("class_id"),
        F.coalesce("_count", F.lit(1)).cast("long").alias("class_size"),
    )
