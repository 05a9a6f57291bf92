"""Vector indexes for retrieval: exact tiles with pruning, and locality-sensitive hashing.

Both work on distinct vectors.  Copies of a vector have one score, and ties go to the smaller id, so the ``keep``
smallest ids of a vector stand for all of its copies; a vector held by a third of all rows is one row here.

**Tiles** (exact).  Centres are fitted on a bounded sample; every vector goes to its nearest centre.  Beside the rows
stands one line a tile: centre, radius (largest angle to a member) and number of rows.  A query at angle a to a centre
has no member with a cosine above cos(a - radius), so a search first scans the most promising tiles that hold k rows,
then only those whose bound reaches the k-th score found there.  Tiles larger than ``tile_rows`` are cut into parts.
What else an index keeps of a row (texts, say) lies in a table of its own, by tile, and is read for the rows found only.

**Signed random projections** (approximate).  A table's code is the signs of some projections on vectors of +1 and -1,
computed in integers; a query looks into the buckets of its own code and of codes with its least certain signs flipped.
Candidates are ranked by their exact cosine.  Queries with fewer than k candidates are finished by the exact plan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from threadlens.functions.numeric import half_even
from threadlens.plans.skew import HOT_ROWS, skew_lookup
from threadlens.schema import TOP_K
from threadlens.sources.scratch import materialize, shared_folder

TILE_ROWS, MAX_TILES = 16_384, 1_024
SAMPLE = 20_000          # distinct vectors that centres are fitted on
FIT_ROUNDS = 5
SLACK = 1e-6             # radians; above the rounding errors of an angle
QUERY_ROWS = 32_768      # queries of one cell at most
LEAST_ROWS, CELLS = 4_096, 256  # cells get fewer queries, down to the former, where they would be fewer than the latter
ZONE_ROWS = 32_768       # distinct vectors of one cell
HELD = 1 << 20           # candidates that a cell holds before they are trimmed
SCAN_BYTES = 16 << 20    # query vectors that a scan ships to its tasks
TABLES, BITS, PROBES = 12, 6, 4
MAX_BITS = 16            # bounds the table of bucket sizes
GROUP_BITS = 3           # of a code: buckets that differ in them alone are searched together
FIXED = 1 << 20          # vectors are hashed as integers of this many steps a unit


def vector_key(vector: Column) -> Column:
    """Equal for equal vectors."""
    return F.md5(vector.cast("array<double>").cast("string").cast("binary"))


def as_stored(vector: str, rows: DataFrame) -> str:
    """Type in which vectors travel: floats as floats, which are as exact and half as long."""
    return "array<float>" if rows.schema[vector].dataType == T.ArrayType(T.FloatType()) else "array<double>"


def kept_rows(rows: DataFrame, id_col: str, vector: str, keep: int, columns: list[str] | None = None) -> DataFrame:
    """(vk, id, place, columns..): the ``keep`` rows of smallest id of every non-null vector, numbered.

    Spark trims to ``keep`` rows a vector within tasks before rows are shuffled.
    """
    names = columns or []
    found = rows.where(F.col(vector).isNotNull()).select(vector_key(F.col(vector)).alias("vk"), F.col(id_col).alias("id"), *names)
    place = F.row_number().over(Window.partitionBy("vk").orderBy("id", *names))
    return found.withColumn("place", place).where(F.col("place") <= keep)


def distinct_vectors(rows: DataFrame, id_col: str, vector: str, keep: int) -> DataFrame:
    """(vk, v, ids): distinct non-null vectors with their ``keep`` smallest ids.

    Spark trims to ``keep`` rows a vector within tasks before rows are shuffled.
    """
    found = rows.where(F.col(vector).isNotNull()).select(vector_key(F.col(vector)).alias("vk"), F.col(vector).cast("array<double>").alias("v"), F.struct(F.col(id_col).alias("id")).alias("item"))
    rank = F.row_number().over(Window.partitionBy("vk").orderBy("item.id"))
    return found.withColumn("rn", rank).where(F.col("rn") <= keep).groupBy("vk").agg(
        F.first("v").alias("v"), F.array_sort(F.collect_list("item")).alias("ids"))


def unit_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column as float64 rows of length one (zero vectors stay zero)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm != 0)


def angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centres.T, -1.0, 1.0))


def fit_centres(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` unit centres of a sample in a random order, by a few rounds of spherical k-means."""
    centres = sample[:n].copy()
    for _ in range(FIT_ROUNDS):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1.0), centres)
    return centres


@dataclass
class Tiles:
    """One line a tile: centre, radius, distinct vectors and parts."""

    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray
    parts: np.ndarray

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Highest cosine that a member of each tile can have with each unit vector."""
        if not self.sizes.any():
            return np.full((len(x), len(self.sizes)), -np.inf)
        best = np.cos(np.maximum(0.0, angles(x, self.centres) - self.radii - SLACK))
        best[:, self.sizes == 0] = -np.inf
        return best

    def first(self, bounds: np.ndarray, k: int) -> np.ndarray:
        """(queries x tiles) marks of the most promising tiles that together hold k vectors."""
        order = np.argsort(-bounds, axis=1, kind="stable")
        before = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
        marks = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(marks, order, before < k, axis=1)
        return marks & np.isfinite(bounds)


@dataclass
class TileIndex:
    """A written index: ``rows`` (part, vk, v, ids, tile) in a folder a tile, and its tiles on the driver.

    ``ids`` are the smallest ids of a vector with their places; ``examples`` (vk, place, columns.., tile) holds what else is kept.
    """

    rows: DataFrame
    tiles: Tiles
    keep: int
    examples: DataFrame | None = None


def build_tile_index(store: DataFrame, path: str | None = None, *, store_id: str, vector: str = "embedding", keep: int = TOP_K, tile_rows: int = TILE_ROWS,
                     max_tiles: int = MAX_TILES, columns: list[str] | None = None) -> TileIndex:
    """Cluster a store once and write it below ``path``; ``columns`` are kept in a table beside the vectors, and written once."""
    spark = store.sparkSession
    path = path or shared_folder(spark, "tiles")
    classes = materialize(query_vectors(store, vector).select(F.col("qk").alias("vk"), F.col("q").alias("v")), "vectors")
    n = classes.count()
    n_tiles = max(1, min(max_tiles, -(-n // tile_rows)))
    # keys are hashes, so their order is a random one; the sample has at most SAMPLE rows
    sample = unit_rows(classes.orderBy("vk").limit(max(SAMPLE, n_tiles)).select("v").toArrow().column(0))
    centres = fit_centres(sample, min(n_tiles, len(sample))) if len(sample) else np.zeros((1, 1))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = angles(unit_rows(batch.column("v")), centres)
                tile = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile, pa.int32()), pa.array(away[np.arange(len(tile)), tile])],
                                                 names=[*batch.schema.names, "tile", "away"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = materialize(classes.mapInArrow(nearest, f"vk string, v {kind}, tile int, away double"), "placed")
    lines = placed.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
    lines = lines.withColumn("parts", F.ceil(F.col("n") / tile_rows).cast("int"))
    # one line a tile, at most ``max_tiles``
    cut = placed.join(F.broadcast(lines.select("tile", "parts")), "tile").withColumn("part", F.pmod(F.xxhash64("vk"), F.col("parts")).cast("int"))
    kept = kept_rows(store, store_id, vector, keep, columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select("vk", "id", "place", *(columns or [])).schema) + ", tile int" if columns else None
    if columns:
        kept.join(cut.select("vk", "tile", "part"), "vk").select("vk", "id", "place", *columns, "tile", "part").repartition("tile", "part").drop("part") \
            .write.option("compression", "zstd").partitionBy("tile").parquet(f"{path}/examples")
        kept = spark.read.schema(fields).parquet(f"{path}/examples")
    ids = kept.groupBy("vk").agg(F.array_sort(F.collect_list(F.struct("id", "place"))).alias("ids"))
    item = ids.schema["ids"].dataType.simpleString()
    cut.join(ids, "vk").select("part", "vk", "v", "ids", "tile").repartition("tile", "part").write.partitionBy("tile").parquet(f"{path}/rows")
    place = spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centres)], "tile int, centre array<double>")
    place.join(lines, "tile", "left").select("tile", "centre", "n", "radius", "parts", F.lit(keep).alias("keep"), F.lit(item).alias("item"), F.lit(kind).alias("kind"),
                                             F.lit(fields).cast("string").alias("fields")).coalesce(1).write.parquet(f"{path}/tiles")
    return open_tile_index(spark, path)


def open_tile_index(spark: SparkSession, path: str) -> TileIndex:
    lines = sorted(spark.read.parquet(f"{path}/tiles").collect(), key=lambda r: r.tile)  # one line a tile
    rows = spark.read.schema(f"part int, vk string, v {lines[0].kind}, ids {lines[0].item}, tile int").parquet(f"{path}/rows")
    examples = spark.read.schema(lines[0].fields).parquet(f"{path}/examples") if lines[0].fields else None
    tiles = Tiles(np.array([r.centre for r in lines]), np.array([r.radius or 0.0 for r in lines]),
                  np.array([r.n or 0 for r in lines], dtype=np.int64), np.array([r.parts or 0 for r in lines], dtype=np.int64))
    return TileIndex(rows, tiles, lines[0].keep, examples)


def best_of(x: np.ndarray, m: np.ndarray, k: int, digits: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of m, cosine) of the k best rows of ``m`` for each row of ``x`` and all that tie with the k-th."""
    rows, columns, found = [], [], []
    step = max(1, min(256, (1 << 22) // max(1, len(m))))
    for at in range(0, len(x), step):
        scores = np.round(x[at:at + step] @ m.T, digits)
        n = min(k, scores.shape[1])
        floor = -np.partition(-scores, n - 1, axis=1)[:, n - 1:n]
        r, c = np.nonzero(scores >= floor)
        rows.append(at + r), columns.append(c), found.append(scores[r, c])
    return tuple(np.concatenate(p) if p else np.empty(0) for p in (rows, columns, found))


def trim(rows: np.ndarray, first_ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries of every row number (score descending, then first id)."""
    order = np.lexsort((first_ids, -scores, rows))
    sorted_rows = rows[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows) < k]


def first_ids(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The smallest id of every vector, as numbers or fixed-width text."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = lists.flatten().field("id").take(pa.array(np.cumsum(sizes) - sizes)).to_numpy(zero_copy_only=False)
    return out.astype(str) if out.dtype == object else out


CANDIDATE = "qk string, vk string, ids {ids}, tile int, score double"


def best_in_cell(x: np.ndarray, marks: np.ndarray, m: np.ndarray, sub: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of m, cosine) of the k best rows of ``m`` for each row of ``x`` among the parts ``sub`` of m that it marks."""
    held, size = [], 0

    def trimmed() -> list[tuple]:
        r, c, score = (np.concatenate(p) for p in zip(*held))
        kept = trim(r, first[c], score, k)
        return [(r[kept], c[kept], score[kept])]

    for s in np.unique(sub).tolist():
        mine, at = np.flatnonzero(marks[:, s]), np.flatnonzero(sub == s)
        if len(mine):
            r, c, score = best_of(x[mine], m[at], k)
            held.append((mine[r], at[c], score))
            size += len(r)
            if size > HELD:
                held = trimmed()
                size = len(held[0][0])
    return trimmed()[0] if held else (np.empty(0, int), np.empty(0, int), np.empty(0))


def cell_candidates(visits: DataFrame, rows: DataFrame, k: int, key: list[str]) -> DataFrame:
    """Best k distinct vectors of every cell for the queries in it: ``visits`` (key.., qk, q, marks), ``rows`` (key.., vk, v, ids, tile, sub).

    ``marks`` are the bits of the parts ``sub`` of a cell that a query visits; whatever their number, a query gives k rows a cell,
    of those that reach its ``least``, if there is such a column.
    """
    ids = rows.schema["ids"].dataType.simpleString()
    schema = pa.schema([("qk", pa.string()), ("vk", pa.string()), ("ids", to_arrow_type(rows.schema["ids"].dataType)), ("tile", pa.int32()), ("score", pa.float64())])

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        bits = np.frombuffer(b"".join(left["marks"].to_pylist()), dtype=np.uint8).reshape(left.num_rows, -1)
        r, c, score = best_in_cell(unit_rows(left["q"]), np.unpackbits(bits, axis=1).astype(bool), unit_rows(right["v"]), right["sub"].to_numpy(), first_ids(right["ids"]), k)
        if "least" in left.column_names:
            enough = score >= left["least"].to_numpy()[r]
            r, c, score = r[enough], c[enough], score[enough]
        c = pa.array(c)
        return pa.Table.from_arrays([left["qk"].take(pa.array(r)), *[right[n].take(c) for n in ("vk", "ids", "tile")], pa.array(score)], schema=schema)

    return visits.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(cell, CANDIDATE.format(ids=ids))


def tile_marks(part: pa.RecordBatch, tiles: Tiles, k: int, threshold: bool) -> np.ndarray:
    """(queries x tiles) marks of the tiles to scan first, or with ``threshold`` of those left whose bound reaches the query's column ``least``."""
    bounds = tiles.bounds(unit_rows(part.column("q")))
    marks = tiles.first(bounds, k)
    if threshold:
        marks = ~marks & (bounds >= part.column("least").to_numpy(zero_copy_only=False)[:, None] - 1e-9) & np.isfinite(bounds)
    return marks


def choose_tiles(queries: DataFrame, tiles: Tiles, k: int, threshold: bool) -> DataFrame:
    """(qk, q, tile): one row for every tile that a query visits, see ``tile_marks``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                r, tile = np.nonzero(tile_marks(part, tiles, k, threshold))
                for low in range(0, len(r), 4096):
                    take = pa.array(r[low:low + 4096])
                    yield pa.RecordBatch.from_arrays([part.column("qk").take(take), part.column("q").take(take), pa.array(tile[low:low + 4096], pa.int32())], names=["qk", "q", "tile"])

    return queries.mapInArrow(run, f"qk string, q {queries.schema['q'].dataType.simpleString()}, tile int")


def zones_of(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring tiles put together as (first tile, past the last) up to ZONE_ROWS vectors; a larger tile is several zones alone."""
    zones, low, held = [], 0, 0
    for tile, n in enumerate(sizes.tolist()):
        if tile > low and held + n > ZONE_ROWS:
            zones.append((low, tile))
            low, held = tile, 0
        held += n
        if n > ZONE_ROWS:
            zones += [(tile, tile + 1)] * (-(-n // ZONE_ROWS))
            low, held = tile + 1, 0
    return zones + [(low, len(sizes))] * (low < len(sizes))


def choose_zones(queries: DataFrame, tiles: Tiles, k: int, threshold: bool, vectors: bool = True) -> DataFrame:
    """(qk, zone, marks, least, q): one row for every zone that a query visits, with the bits of its tiles there; without ``vectors`` (zone) alone."""
    zones = zones_of(tiles.sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                marks = tile_marks(part, tiles, k, threshold)
                least = part.column("least") if threshold else pa.array(np.full(part.num_rows, -np.inf))
                for zone, (low, high) in enumerate(zones):
                    r = np.flatnonzero(marks[:, low:high].any(axis=1))
                    if len(r):
                        take, number = pa.array(r), pa.array(np.full(len(r), zone), pa.int32())
                        bits = pa.array([row.tobytes() for row in np.packbits(marks[r, low:high], axis=1)], pa.binary())
                        yield pa.RecordBatch.from_arrays([part.column("qk").take(take), number, bits, least.take(take), part.column("q").take(take)] if vectors else [number],
                                                         names=["qk", "zone", "marks", "least", "q"] if vectors else ["zone"])

    return queries.mapInArrow(run, f"qk string, zone int, marks binary, least double, q {queries.schema['q'].dataType.simpleString()}" if vectors else "zone int")


def scan_cells(asked: DataFrame, index: TileIndex, k: int, threshold: bool) -> DataFrame:
    """Candidates of all visits; a cell is one zone of tiles and at most about QUERY_ROWS queries.

    A query is shuffled once a zone and a vector once a block of queries, however small the tiles are, and a cell gives k rows a query.
    Of a vector's ids only the smallest goes along.
    """
    spark, sizes = asked.sparkSession, index.tiles.sizes
    zones = zones_of(sizes)
    counts = {r.zone: r.n for r in choose_zones(asked, index.tiles, k, threshold, False).groupBy("zone").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a zone
    block = max(1, min(QUERY_ROWS, max(LEAST_ROWS, sum(counts.values()) // CELLS)))
    cells = spark.createDataFrame([(z, -(-n // block)) for z, n in counts.items()], "zone int, blocks int")
    of: dict[int, list[int]] = {}
    for zone, (low, high) in enumerate(zones):
        for tile in range(low, high):
            of.setdefault(tile, []).append(zone)
    held = [(tile, z[0], len(z), tile - zones[z[0]][0]) for tile, z in of.items() if sizes[tile] and not counts.keys().isdisjoint(z)]
    places = spark.createDataFrame(held, "tile int, first int, zones int, sub int")
    left = choose_zones(asked, index.tiles, k, threshold).join(F.broadcast(cells), "zone").select("qk", "q", "marks", "least", "zone", F.pmod(F.xxhash64("qk"), F.col("blocks")).cast("int").alias("block"))
    right = index.rows.where(F.col("tile").isin([h[0] for h in held])).join(F.broadcast(places), "tile") \
        .withColumn("zone", (F.col("first") + F.pmod(F.xxhash64("vk"), F.col("zones"))).cast("int")).join(F.broadcast(cells), "zone") \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cell_candidates(left, right.select("vk", "v", F.slice("ids", 1, 1).alias("ids"), "tile", "sub", "zone", "block"), k, ["zone", "block"])


def scan_in_place(visits: DataFrame, index: TileIndex, k: int) -> DataFrame:
    """Candidates of a bounded set of visits: the queries are shipped to the rows of the visited tiles, which are not shuffled."""
    table = visits.groupBy("qk").agg(F.first("q").alias("q"), F.collect_list("tile").alias("tiles")).toArrow()  # at most SCAN_BYTES, see search_tiles
    keys, x = np.array(table["qk"].to_pylist(), dtype=object), unit_rows(table["q"])
    owner = np.repeat(np.arange(len(keys)), [len(t) for t in table["tiles"].to_pylist()])
    tiles = np.array([t for row in table["tiles"].to_pylist() for t in row], dtype=np.int64)
    order = np.argsort(tiles, kind="stable")
    tiles, owner = tiles[order], owner[order]
    ids = index.rows.schema["ids"].dataType
    kind = to_arrow_type(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here, first, found = batch.column("tile").to_numpy(), first_ids(batch.column("ids")), []
            vectors = unit_rows(batch.column("v"))
            for tile in np.unique(here).tolist():
                low, high = np.searchsorted(tiles, [tile, tile + 1])
                if low == high:
                    continue
                at, mine = np.flatnonzero(here == tile), owner[low:high]
                r, c, score = best_of(x[mine], vectors[at], k)
                found.append((mine[r], at[c], score))
            if not found:
                continue
            r, c, score = (np.concatenate(p) for p in zip(*found))
            kept = trim(r, first[c], score, k)  # k rows a query and batch, however many tiles it holds
            at = pa.array(c[kept])
            yield pa.RecordBatch.from_arrays([pa.array(keys[r[kept]].tolist(), pa.string()), batch.column("vk").take(at), batch.column("ids").take(at).cast(kind),
                                              batch.column("tile").take(at), pa.array(score[kept])], names=["qk", "vk", "ids", "tile", "score"])

    rows = index.rows.where(F.col("tile").isin(np.unique(tiles).tolist())).select("vk", "v", F.slice("ids", 1, 1).alias("ids"), "tile")
    return rows.mapInArrow(run, CANDIDATE.format(ids=ids.simpleString()))


def met_once(candidates: DataFrame) -> DataFrame:
    """Candidates of overlapping cells, each vector once a query."""
    return candidates.groupBy("qk", "vk").agg(F.max("score").alias("score"), F.first("ids").alias("ids"), F.first("tile").alias("tile"))


def best_vectors(candidates: DataFrame, k: int) -> DataFrame:
    """The k best vectors of every distinct query; no vector may come twice."""
    best = Window.partitionBy("qk").orderBy(F.desc("score"), F.col("ids")[0]["id"])
    return candidates.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k).drop("rn")


def ranked(few: DataFrame, k: int) -> DataFrame:
    """(qk, rank, item, vk, score): the k best rows of every distinct query from its best vectors with all their ids."""
    each = few.select("qk", "score", "vk", F.explode("ids").alias("item"))
    order = Window.partitionBy("qk").orderBy(F.desc("score"), "item.id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def query_vectors(queries: DataFrame, vector: str) -> DataFrame:
    """(qk, q): distinct query vectors."""
    return queries.where(F.col(vector).isNotNull()).select(vector_key(F.col(vector)).alias("qk"), F.col(vector).cast(as_stored(vector, queries)).alias("q")) \
        .groupBy("qk").agg(F.first("q").alias("q"))


def answer(queries: DataFrame, found: DataFrame, query_id: str, vector: str, extra: list[str] = ()) -> DataFrame:
    """(query_id, rank, store_id, similarity, extra..) of every query from the rows of its vector; at most k a vector."""
    packed = found.groupBy("qk").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("item.id").alias("store_id"), F.col("score"), *extra))).alias("top"))
    facts = queries.where(F.col(vector).isNotNull()).select(F.col(query_id).alias("query_id"), vector_key(F.col(vector)).alias("vk"))
    looked = skew_lookup(facts, packed, "vk", "qk", spread="query_id", how="inner", hot_rows=HOT_ROWS)
    return looked.select("query_id", F.inline("top")).select("query_id", "rank", "store_id", half_even(F.col("score"), 4).alias("similarity"), *extra)


def search_tiles(queries: DataFrame, index: TileIndex, k: int = TOP_K, *, query_id: str, vector: str = "embedding", in_place: bool | None = None,
                 extra: list[str] = ()) -> DataFrame:
    """Exact (query_id, rank, store_id, similarity, extra..): the k best rows of the index for every query; see ``search_vectors``."""
    return answer(queries, search_vectors(queries, index, k, vector=vector, in_place=in_place, extra=extra), query_id, vector, list(extra))


def search_vectors(queries: DataFrame, index: TileIndex, k: int = TOP_K, *, vector: str = "embedding", in_place: bool | None = None,
                   extra: list[str] = ()) -> DataFrame:
    """(qk, rank, item, score, extra..): the k best rows of the index for every distinct query vector.

    ``in_place`` scans the visited tiles where they lie, for query vectors of at most SCAN_BYTES (``None``: decided by
    counting them up to that bound); otherwise queries and visited tiles meet in cells.  Both give the same rows.
    Candidates travel with one id; the other ids, and ``extra`` columns, are fetched for the k best vectors alone, from their tiles.
    """
    if k > index.keep:
        raise ValueError(f"the index keeps {index.keep} ids a vector")
    asked = materialize(query_vectors(queries, vector), "queries")
    if in_place is None:
        n_tiles, dim = index.tiles.centres.shape
        limit = max(1, SCAN_BYTES // (8 * dim + 4 * n_tiles + 64))
        in_place = asked.limit(limit + 1).count() <= limit

    def scan(rows: DataFrame, threshold: bool) -> DataFrame:
        return scan_in_place(choose_tiles(rows, index.tiles, k, threshold), index, k) if in_place else scan_cells(rows, index, k, threshold)

    first = materialize(best_vectors(scan(asked, False), k), "seen-first")
    rest = scan(limits_of(asked, first, k), True)
    few = materialize(best_vectors(first.unionByName(rest), k).drop("ids"), "nearest")  # tiles are disjoint, so a vector is met once
    tiles = [r.tile for r in few.select("tile").distinct().collect()]  # at most one row a tile
    found = ranked(few.join(index.rows.where(F.col("tile").isin(tiles)).select("vk", "ids"), "vk"), k)
    if not extra:
        return found
    known = index.examples.where(F.col("tile").isin(tiles)).select("vk", "place", *extra)
    return found.withColumn("place", F.col("item.place")).join(known, ["vk", "place"])


def limits_of(asked: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """(qk, q, least): the k-th best score seen so far, which every further candidate has to reach.

    A scan gives at most k scores a cell, and few cells are scanned first, so the list of a query is short.
    """
    scores = seen.groupBy("qk").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    return asked.join(scores, "qk", "left").select("qk", "q", F.when(F.size("s") >= k, F.col("s")[k - 1]).otherwise(F.lit(float("-inf"))).alias("least"))


def count_visits(queries: DataFrame, index: TileIndex, k: int = TOP_K, *, vector: str = "embedding") -> DataFrame:
    """(qk, tiles): tiles that a search visits for every distinct query vector."""
    asked = query_vectors(queries, vector)
    first = choose_tiles(asked, index.tiles, k, False)
    rest = choose_tiles(limits_of(asked, scan_cells(asked, index, k, False), k), index.tiles, k, True)
    return first.unionByName(rest).groupBy("qk").agg(F.count(F.lit(1)).alias("tiles"))


# ---------------------------------------------------------------- signed random projections

def signs(tables: int, bits: int, dim: int, seed: int) -> np.ndarray:
    """(dim x tables*bits) of +1 and -1: the parity of the first hexadecimal digit of md5('seed:table:bit:place')."""
    return np.array([[1 if int(hashlib.md5(f"{seed}:{t}:{b}:{d}".encode()).hexdigest()[0], 16) % 2 == 0 else -1 for t in range(tables) for b in range(bits)]
                     for d in range(dim)], dtype=np.int64)


def bucket_codes(vectors: np.ndarray, planes: np.ndarray, tables: int, bits: int, probes: int) -> np.ndarray:
    """(rows x tables x 1 + probes) codes: a row's own, then with its least certain signs flipped one at a time (ties: lower bit)."""
    fixed = np.floor(vectors * FIXED + 0.5).astype(np.int64)
    side = (fixed @ planes).reshape(len(vectors), tables, bits)
    own = ((side > 0) << np.arange(bits)).sum(axis=2)
    weak = np.argsort(np.abs(side), axis=2, kind="stable")[:, :, :probes]
    return np.concatenate([own[:, :, None], own[:, :, None] ^ (1 << weak)], axis=2)


def hashed(vectors: DataFrame, vector: str, tables: int, bits: int, seed: int) -> DataFrame:
    """``vectors`` with ``codes``, their bucket in every table; vectors are hashed at unit length."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = unit_rows(part.column(vector))
                planes = signs(tables, bits, x.shape[1], seed) if planes is None else planes
                codes = bucket_codes(x, planes, tables, bits, 0)[:, :, 0]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(codes.tolist(), pa.list_(pa.int32()))], names=[*part.schema.names, "codes"])

    return vectors.mapInArrow(run, f"{fields}, codes array<int>")


def probed(queries: DataFrame, tables: int, bits: int, probes: int, seed: int) -> DataFrame:
    """``queries`` (qk, q) once for every table and group of buckets they look into, with the bits ``marks`` of the buckets there."""
    low = min(bits, GROUP_BITS)
    kind = queries.schema["q"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = unit_rows(part.column("q"))
                planes = signs(tables, bits, x.shape[1], seed) if planes is None else planes
                codes = bucket_codes(x, planes, tables, bits, probes)
                for t in range(tables):
                    rows = np.repeat(np.arange(len(x)), codes.shape[2])
                    met, place = np.unique(rows << bits | codes[:, t].ravel() >> low, return_inverse=True)
                    marks = np.zeros((len(met), 1 << low), dtype=bool)
                    marks[place, codes[:, t].ravel() & (1 << low) - 1] = True
                    take = pa.array(met >> bits)
                    yield pa.RecordBatch.from_arrays([part.column("qk").take(take), part.column("q").take(take), pa.array(np.full(len(met), t), pa.int32()),
                                                      pa.array(met & (1 << bits) - 1, pa.int32()), pa.array([row.tobytes() for row in np.packbits(marks, axis=1)], pa.binary())],
                                                     names=["qk", "q", "t", "grp", "marks"])

    return queries.mapInArrow(run, f"qk string, q {kind}, t int, grp int, marks binary")


def ann_topk(queries: DataFrame, store: DataFrame, k: int = TOP_K, *, query_id: str, store_id: str, vector: str = "embedding", tables: int = TABLES,
             bits: int = BITS, probes: int = PROBES, seed: int = 0, cell_rows: int = ZONE_ROWS) -> DataFrame:
    """(query_id, rank, store_id, similarity): k rows per query among those that share a bucket with it, by exact cosine.

    A query travels once for every group of 2**GROUP_BITS buckets that it looks into, and a group gives k rows a query.
    Groups are cut into cells of at most about ``cell_rows`` store rows and QUERY_ROWS queries; nothing in a bucket is
    capped.  Queries that meet fewer than k rows get their exact answer instead.
    """
    if bits > MAX_BITS:
        raise ValueError(f"at most {MAX_BITS} bits")
    asked = materialize(query_vectors(queries, vector), "queries")
    classes = distinct_vectors(store, store_id, vector, k).withColumn("v", F.col("v").cast(as_stored(vector, store)))
    low = min(bits, GROUP_BITS)
    rows = materialize(hashed(classes, "v", tables, bits, seed), "buckets").select("vk", "v", "ids", F.posexplode("codes").alias("t", "code")) \
        .withColumn("grp", F.shiftright("code", low)).withColumn("sub", F.col("code").bitwiseAND(F.lit((1 << low) - 1)))
    left = probed(asked, tables, bits, min(probes, bits), seed)
    # one row a group: at most tables * 2**MAX_BITS
    sizes = rows.groupBy("t", "grp").agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("parts"))
    asked_sizes = left.groupBy("t", "grp").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks"))
    cells = materialize(sizes.join(asked_sizes, ["t", "grp"]), "cells")
    left = left.join(F.broadcast(cells), ["t", "grp"]).select("t", "grp", "qk", "q", "marks", F.pmod(F.xxhash64("qk"), F.col("blocks")).cast("int").alias("block"),
                                                              F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = rows.join(F.broadcast(cells), ["t", "grp"]).select("t", "grp", "vk", "v", "ids", F.lit(0).alias("tile"), "sub", F.pmod(F.xxhash64("vk"), F.col("parts")).cast("int").alias("part"),
                                                               F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    found = materialize(ranked(best_vectors(met_once(cell_candidates(left, right, k, ["t", "grp", "part", "block"])), k), k), "ranked")
    enough = found.groupBy("qk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select(F.col("qk").alias("vk"), F.lit(True).alias("enough"))
    marked = skew_lookup(queries.where(F.col(vector).isNotNull()).select(F.col(query_id), F.col(vector), vector_key(F.col(vector)).alias("__vk")),
                         enough, "__vk", "vk", spread=query_id, how="left").drop("__vk")
    short = materialize(marked.where("enough is null").select(query_id, vector), "short")
    done = answer(queries, found.join(enough.select(F.col("vk").alias("qk")), "qk", "left_semi"), query_id, vector)
    if short.isEmpty():
        return done
    index = build_tile_index(store, store_id=store_id, vector=vector, keep=k)
    return done.unionByName(search_tiles(short, index, k, query_id=query_id, vector=vector))
