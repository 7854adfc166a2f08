"""SimHash near-duplicates through an inverted index over byte positions.

A fingerprint has eight byte positions. Two that differ in at most three bits differ in at
most three bytes, so they share at least five positional bytes. A posting list of one
positional byte would hold one 256th of the corpus; lists are therefore intersected four at
a time when the index is built. The fourteen sets of four positions in ``POSITIONS`` are
chosen so that any five positions hold at least one of them: every pair with five shared
bytes meets in some list, and lists are keyed by 32 bits. Within a list the shared
positional bytes of each pair are tallied, pairs below five are dropped, the rest verified
bit by bit. A list emits a spanning forest of its links, never its pairs.

A list longer than ``LIST_LIMIT`` takes another exact way whose cost is linear in its
length: see ``_linked_by_centres``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm import common, components

WORDS = 3
SEED = 42
MAX_BITS = 3
SHARED_BYTES = 8 - MAX_BITS
#: Longest posting list whose pairs are compared inside one task.
LIST_LIMIT = 4096


def _steiner_quadruples() -> list[tuple[int, ...]]:
    """Sets of four of eight positions whose numbers cancel in XOR: any three others are in one."""
    return [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]


#: Any three differing positions lie outside at least one of these.
POSITIONS = _steiner_quadruples()


def _mixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """The hashes as they are for table 0, others made from them for the rest."""
    if not table:
        return hashes
    x = hashes + np.uint64(table * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table_fingerprints(text: str, words: int = WORDS, tables: int = 1) -> list[int]:
    """The 64 bits of each table as signed numbers; 0 for a text without words."""
    own = text.encode("utf-8").lower().split()  # bytes: only A-Z and the six blanks
    if not own:
        return [0] * tables
    if len(own) < words:
        shingles = [b" ".join(own)]
    else:
        shingles = map(b" ".join, zip(*(own[i:] for i in range(words))))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    found = []
    for table in range(tables):
        total = np.zeros(64, np.int64)
        for start in range(0, len(hashes), 8192):
            part = _mixed(hashes[start : start + 8192], table).view(np.uint8)
            total += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        bits = (2 * total > len(hashes)).astype(np.uint8)
        found.append(int(np.packbits(bits, bitorder="little").view("<i8")[0]))
    return found


def fingerprint(text: str, words: int = WORDS) -> int:
    """The fingerprint of table 0."""
    return table_fingerprints(text, words)[0]


def fingerprints(
    df: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS, tables: int = 1
) -> DataFrame:
    """``(id, fp, fps)`` for every row: the fingerprint of table 0, and those of all tables.

    A null text counts as empty. Other columns are left out.
    """
    source = df.select(F.col(f"`{id}`").cast("long").alias("id"), common.whole(text).alias("t"))

    def rows(batch):
        found = [table_fingerprints(t, words, tables) for t in batch.column(1).to_pylist()]
        return [batch.column(0), common.longs([f[0] for f in found]), pa.array(found, pa.list_(pa.int64()))]

    return common.map_batches(source, rows, "id long, fp long, fps array<long>")


def _forest(links: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Links that join what is not yet joined."""
    parent = list(range(size))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, j in links:
        a, b = top(i), top(j)
        if a != b:
            parent[a] = b
            kept.append((i, j))
    return kept


def _verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that reach the shared positional bytes and then differ in few enough bits."""
    differ = a[:, None] ^ b[None, :]
    tally = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(2)
    return (tally >= SHARED_BYTES) & (np.bitwise_count(differ) <= MAX_BITS)


def _list_links(members: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links within one posting list."""
    found: list[np.ndarray] = []
    unsigned = np.ascontiguousarray(members).view(np.uint64)
    for start in range(0, len(members), 256):
        block = _verified(unsigned[start : start + 256], unsigned[start:])
        i, j = np.nonzero(block)
        keep = i < j
        part = np.stack([i[keep] + start, j[keep] + start], 1)
        found.append(np.array(_forest(part.tolist(), len(members))).reshape(-1, 2).astype(int))
    return _forest(np.concatenate(found).tolist(), len(members))


def _read_lists(limit: int):
    """Rows sorted by list: links of the short lists, the keys of the long ones."""

    def run(batches):
        held: list[np.ndarray] = []
        key, size = None, 0

        def close():
            if key is None or size < 2:
                return [], []
            if size > limit:
                return [], [key]
            members = np.concatenate(held)
            return [(int(members[i]), int(members[j]), *key) for i, j in _list_links(members)], []

        for batch in batches:
            sets, keys, fps = (batch.column(i).to_numpy() for i in range(3))
            if not len(fps):
                continue
            change = np.flatnonzero((np.diff(sets) != 0) | (np.diff(keys) != 0)) + 1
            starts, stops = np.r_[0, change], np.r_[change, len(fps)]
            links, long = [], []
            # runs inside the batch with one row need no look; the first and last may go on
            wide = np.flatnonzero(stops - starts > 1)
            for run_no in sorted({0, len(starts) - 1, *wide.tolist()}):
                start, stop = starts[run_no], stops[run_no]
                own = (int(sets[start]), int(keys[start]))
                if own != key:
                    more, longer = close()
                    links += more
                    long += longer
                    key, size, held = own, 0, []
                size += int(stop - start)
                if size <= limit:
                    held.append(fps[start:stop])
                else:
                    held = []
            yield _found(links, long)
        yield _found(*close())

    return run


def _found(links, long) -> pa.RecordBatch:
    rows = links + [(None, None, *key) for key in long]
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "list", "key"]
    )


def _postings(fps: DataFrame) -> DataFrame:
    """``(list, key, fp)``: for each set of positions the fingerprint's bytes there.

    Lists are numbered through the tables: those of a table follow those of the one before.
    """

    def key(positions):
        parts = [
            F.shiftleft(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)), 8 * i)
            for i, p in enumerate(positions)
        ]
        return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(parts[3])

    first = F.col("table") * len(POSITIONS)
    entries = F.array(*[
        F.struct((first + i).cast("int").alias("list"), key(positions).alias("key"))
        for i, positions in enumerate(POSITIONS)
    ])
    return fps.select(F.explode(entries).alias("e"), "fp").select("e.list", "e.key", "fp")


def _table() -> Column:
    return F.floor(F.col("list") / len(POSITIONS)).cast("int").alias("table")


def _linked_by_centres(postings: DataFrame) -> DataFrame:
    """Links within long lists, without comparing pairs.

    Members share four bytes, so links differ only in the other 32 bits. Two fingerprints
    differ in at most three bits just if some value lies within one bit of one and two bits
    of the other. Each member is sent to the 1 + 32 + 496 values within two bits; where a
    value has a member within one bit, all members sent to it differ from that one in three
    bits at most, and all are linked to it.
    """
    size = 1 + 32 + 496

    def around(batch):
        sets, fps = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        flips = {}
        for number in np.unique(sets).tolist():
            fixed = POSITIONS[number % len(POSITIONS)]
            single = [1 << (8 * p + i) for p in range(8) if p not in fixed for i in range(8)]
            double = [x | y for x, y in combinations(single, 2)]
            flips[number] = np.array([0, *single, *double], np.uint64).view(np.int64)
        own = np.stack([flips[n] for n in sets.tolist()]) if len(sets) else np.zeros((0, size), np.int64)
        near = np.tile(np.arange(size) <= 32, len(sets))
        tables = np.repeat(sets // len(POSITIONS), size).astype(np.int32)
        return [pa.array(tables), pa.array((fps[:, None] ^ own).ravel()), pa.array(np.repeat(fps, size)), pa.array(near)]

    sent = common.map_batches(postings, around, "table int, value long, fp long, near boolean")
    centres = sent.where("near").groupBy("table", "value").agg(F.min("fp").alias("centre"))
    joined = sent.join(centres, ["table", "value"]).where("fp <> centre")
    return joined.select("table", F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()


def links(fps: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """Links ``(table, a, b)`` that connect what differs in at most three bits in a table.

    ``fps`` has distinct rows ``(table, fp)``. Every linked pair is connected in the result,
    not each one listed. An empty input has none.
    """
    postings = _postings(fps)
    dealt = postings.repartition("list", "key").sortWithinPartitions("list", "key")
    common.prepare(fps.sparkSession)
    found = common.stage(
        dealt.mapInArrow(_read_lists(limit), "a long, b long, list int, key long"), "found"
    )
    short = found.where("a is not null").select(_table(), "a", "b")
    long = found.where("a is null").select("list", "key")
    if not long.take(1):
        return short
    return short.union(_linked_by_centres(postings.join(long, ["list", "key"], "left_semi")))


def _links_of_tables(rows: DataFrame, limit: int) -> DataFrame:
    """Links between fingerprints of table 0 of rows that are linked in any table.

    A fingerprint of a table is stood for by the smallest one of table 0 that comes with it.
    """
    every = rows.select("fp", F.posexplode("fps").alias("table", "own")).distinct()
    heads = common.stage(every.groupBy("table", "own").agg(F.min("fp").alias("head")), "heads")
    same = every.join(heads, ["table", "own"]).where("fp <> head").select("fp", "head")
    near = links(heads.select("table", F.col("own").alias("fp")), limit)
    left = heads.withColumnsRenamed({"own": "a", "head": "from"})
    right = heads.withColumnsRenamed({"own": "b", "head": "to"})
    return same.toDF("a", "b").union(near.join(left, ["table", "a"]).join(right, ["table", "b"]).select("from", "to"))


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    limit: int = LIST_LIMIT,
    words: int = WORDS,
    tables: int = 1,
) -> DataFrame:
    """``(id, fp, root, component)`` for every row of ``df``; ``root`` names the component too.

    ``component`` is the smallest id reachable over links of three or fewer differing bits,
    the row's own included. With several ``tables`` each text has as many independent
    fingerprints, and a link in any of them counts. A null id takes part but is never the smallest; a component of
    null ids only has a null. Repeated rows stay repeated; equal texts are always linked.
    Other columns are left out. Copies are counted once before any comparison, so a text
    held by a third of all rows is one fingerprint.
    """
    rows = common.stage(fingerprints(df, text, id, words, tables), "fingerprints")
    distinct = common.stage(rows.groupBy("fp").agg(F.min("id").alias("smallest")), "distinct")
    if tables == 1:
        found = links(distinct.select(F.lit(0).alias("table"), "fp"), limit).select("a", "b")
    else:
        found = _links_of_tables(rows, limit)
    linked = components.roots(found)
    # a root stands for its component; it is itself no child
    named = distinct.join(
        linked.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left"
    ).withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("smallest").alias("component"))
    labels = common.stage(named.join(smallest, "root").select("fp", "root", "component"), "labels")
    return rows.join(labels, "fp").select("id", "fp", "root", "component")


def one_of_each(
    df: DataFrame, text: str = "text", id: str = "doc_id", words: int = WORDS, tables: int = 1
) -> DataFrame:
    """One row of every component, with all columns of ``df`` as they are.

    It is the row with the smallest id, null ids last, then the smallest fingerprint. Of
    rows that repeat both, the one with the smallest text stays.
    """
    order = F.struct(F.col("id").isNull(), "id", "fp")
    stays = near_duplicates(df, text, id, LIST_LIMIT, words, tables).groupBy("root").agg(F.min(order).alias("o"))
    stays = stays.select(F.col("o.id").alias("sid"), F.col("o.fp").alias("sfp"))
    fp, place = common.fresh(df, "own_fp"), common.fresh(df, "own_place")

    def run(texts):
        return common.longs([fingerprint(t, words) for t in texts])

    marked = common.append_column(df, run, common.whole(text), fp, "long")
    own = marked.join(
        stays, F.col(f"`{id}`").cast("long").eqNullSafe(F.col("sid")) & (F.col(f"`{fp}`") == F.col("sfp"))
    )
    again = Window.partitionBy("sid", "sfp").orderBy(F.col(f"`{text}`"))
    first = own.withColumn(place, F.row_number().over(again)).where(F.col(f"`{place}`") == 1)
    return first.select(*[F.col(f"`{c}`") for c in df.columns])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
