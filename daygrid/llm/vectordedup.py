"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, representatives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import staged
from daygrid.llm.components import components
from daygrid.llm.vectors import matrix, usable_rows

THRESHOLD = 0.9
#: Vectors that the cells are fitted on, at most. Every vector is assigned and compared.
SAMPLE = 20_000
#: Vectors for each cell, and the most cells; the centroids sent to tasks are bounded by it.
PER_CELL = 4_000
MOST_CELLS = 4_096
#: The distance of two unit vectors that just link. Measured from the border of two cells, the
#: margins of two vectors that link across it add up to that at most.
REACH = float(np.sqrt(2 - 2 * THRESHOLD)) + 1e-9
#: Rows and bytes of a block, at most on average: a side of one product.
BLOCK = 8_192
BLOCK_BYTES = 16 << 20
#: Rows of the left side that are multiplied at a time.
SLICE = 512
ROUNDS = 8


def spherical_kmeans(x: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows."""
    rng = np.random.default_rng(seed)
    x = x[np.lexsort(x.T[::-1])]  # the same fit whatever order the rows came in
    centroids = x[rng.choice(len(x), size=min(cells, len(x)), replace=False)]
    for _ in range(ROUNDS):
        home = np.argmax(x @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1)
        filled = norms > 1e-12
        centroids[filled] = sums[filled] / norms[filled, None]
    return centroids


def _units(x: np.ndarray) -> np.ndarray:
    """Unit rows; scaling by the largest component first keeps squares in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _fit_cells(classes: DataFrame) -> dict[int, np.ndarray]:
    """Centroids for every vector length that the bounded sample holds."""
    total = classes.count()
    drawn = classes.select("v")
    if total > SAMPLE:
        drawn = drawn.sample(fraction=0.9 * SAMPLE / total, seed=11)
    # The limit only guards the bound of the sample, which the fraction keeps below it.
    rows = drawn.limit(SAMPLE).toPandas()["v"]
    fitted: dict[int, np.ndarray] = {}
    for width in sorted({len(v) for v in rows}):
        x = _units(matrix([v for v in rows if len(v) == width]))
        cells = max(1, min(MOST_CELLS, total * len(x) // max(1, len(rows)) // PER_CELL))
        fitted[width] = spherical_kmeans(x, cells)
    return fitted


def _assign(cells: dict[int, np.ndarray], kind: str):
    """Rows (cid, n, width, cell, v): the cell of every vector, its components as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby(batch["v"].map(len)):
                raw = matrix(part["v"])
                centroids = cells.get(int(width))
                home = 0 if centroids is None else (_units(raw) @ centroids.T).argmax(axis=1)
                yield pd.DataFrame(
                    {
                        "cid": part["cid"].to_numpy(),
                        "n": part["n"].to_numpy(),
                        "width": int(width),
                        "cell": home,
                        "v": [v.tobytes() for v in raw.astype(kind)],
                    }
                )

    return run


def _pack(part: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block as one row of bytes."""
    return pd.DataFrame(
        {
            "width": part["width"].iloc[:1],
            "cell": part["cell"].iloc[:1],
            "block": part["block"].iloc[:1],
            "cids": [part["cid"].to_numpy(np.int64).tobytes()],
            "ns": [part["n"].to_numpy(np.int64).tobytes()],
            "vs": [b"".join(part["v"])],
        }
    )


def _unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, counts and vectors of a block."""
    cids, ns = np.frombuffer(row.cids, np.int64), np.frombuffer(row.ns, np.int64)
    kind = np.float32 if len(row.vs) == 4 * len(cids) * row.width else np.float64
    return cids, ns, np.frombuffer(row.vs, kind).reshape(len(cids), row.width)


def _send(cells: dict[int, np.ndarray]):
    """A block for its own cell, whole, and for every other cell: there the vectors within REACH of
    the border of the two cells, nearest to it first, with their margins ``ms``.

    The margin is the component along the unit vector between the two centroids. Its amounts on
    the two sides add up to no more than the distance of the two vectors.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in (row for batch in batches for row in batch.itertuples()):
            cids, ns, raw = _unpack(row)
            x = _units(raw.astype(np.float64))
            centroids = cells.get(row.width)
            for other in range(1 if centroids is None else len(centroids)):
                if other == row.cell:
                    margin, at = np.zeros(len(x)), np.arange(len(x))
                else:
                    across = centroids[row.cell] - centroids[other]
                    length = np.linalg.norm(across)
                    margin = x @ (across / length) if length > 1e-9 else np.zeros(len(x))
                    at = np.argsort(margin, kind="stable")[: (margin <= REACH).sum()]
                if len(at):
                    yield pd.DataFrame(
                        {
                            "width": [row.width],
                            "cell": [row.cell],
                            "other": [other],
                            "block": [row.block],
                            "cids": [cids[at].tobytes()],
                            "ns": [ns[at].tobytes()],
                            "ms": [margin[at].tobytes()],
                            "vs": [raw[at].tobytes()],
                        }
                    )

    return run


def _hits(x: np.ndarray, y: np.ndarray, mx: np.ndarray, my: np.ndarray, same: bool) -> np.ndarray:
    """The 0/1 link matrix of raw rows. Products in single precision leave out what is below the
    threshold by more than their rounding; cosines in double precision decide on the rest."""
    x, y = _units(x.astype(np.float64)), _units(y.astype(np.float64))
    low = np.float32(THRESHOLD - (x.shape[1] + 8) * 2.0**-23)
    x_short, y_short = x.astype(np.float32), y.astype(np.float32)
    hit = np.zeros((len(x), len(y)), dtype=bool)
    for at in range(0, len(x), SLICE):
        near = int(np.searchsorted(my, REACH - mx[at], side="right"))
        maybe = x_short[at : at + SLICE] @ y_short[:near].T >= low
        if same:
            np.fill_diagonal(maybe[:, at:], False)
        rows, columns = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
        if len(rows):
            there = np.ix_(rows, columns)
            cosines = x[at + rows] @ y[columns].T
            hit[np.ix_(at + rows, columns)] = maybe[there] & (cosines >= THRESHOLD)
    return hit


def _spanning(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a 0/1 link matrix without empty columns, the label (least row number) of every row and
    column. Rows and columns are looked at once each, however long a chain of links is."""
    turned = np.ascontiguousarray(hit.T)
    of_row, of_column = np.full(len(hit), -1), np.full(len(turned), -1)
    for start in range(len(hit)):
        if of_row[start] < 0:
            of_row[start], reached = start, np.array([start])
            while len(reached):
                beside = np.flatnonzero(hit[reached].any(axis=0) & (of_column < 0))
                of_column[beside] = start
                reached = np.flatnonzero(turned[beside].any(axis=0) & (of_row < 0))
                of_row[reached] = start
    return of_row, of_column


def _compare(part: pd.DataFrame) -> pd.DataFrame:
    """Links between the two sides of a task: counts by row, and edges that span them."""
    sides = {row.side: row for row in part.itertuples()}
    same = part["low"].iloc[0] == part["high"].iloc[0] and part["i"].iloc[0] == part["j"].iloc[0]
    none = pd.DataFrame({"cid": [], "links": [], "other": []}).astype("int64")
    if len(sides) < 2 and not same:
        return none
    left, right = sides[0], sides[0 if same else 1]
    (a, n_a, x), (b, n_b, y) = _unpack(left), _unpack(right)
    hit = _hits(x, y, np.frombuffer(left.ms), np.frombuffer(right.ms), same)
    rows, columns = hit.any(axis=1), hit.any(axis=0)
    if not rows.any():
        return none
    hit, a, n_a, b, n_b = hit[np.ix_(rows, columns)], a[rows], n_a[rows], b[columns], n_b[columns]
    links, back = np.zeros(len(a)), np.zeros(len(b))
    for at in range(0, len(a), SLICE):
        piece = hit[at : at + SLICE].astype(np.float64)
        links[at : at + SLICE] = piece @ n_b
        back += n_a[at : at + SLICE] @ piece
    of_row, of_column = _spanning(hit)
    out = [
        pd.DataFrame({"cid": a, "links": links, "other": a[of_row]}),
        pd.DataFrame({"cid": b, "links": 0 if same else back, "other": a[of_column]}),
    ]
    return pd.concat(out).astype("int64")


def _tasks(sent: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block at its side of every pair of blocks that is compared: of cells low and high,
    the blocks i and j. A block that meets itself is there once."""
    theirs = blocks.select("width", F.col("cell").alias("other"), "blocks")
    cell, other, block = F.col("cell"), F.col("other"), F.col("block")

    def place(k):
        return F.struct(
            F.when(cell == other, F.least(block, k)).when(cell < other, block).otherwise(k).alias("i"),
            F.when(cell == other, F.greatest(block, k)).when(cell < other, k).otherwise(block).alias("j"),
            F.when(cell == other, k < block).otherwise(cell > other).cast("int").alias("side"),
        )

    places = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), place)
    return sent.join(theirs, ["width", "other"]).select(
        "width", F.least(cell, other).alias("low"), F.greatest(cell, other).alias("high"),
        F.explode(places).alias("p"), "cids", "ns", "ms", "vs",
    ).select("width", "low", "high", "p.i", "p.j", "p.side", "cids", "ns", "ms", "vs")


def _dealt(frame: DataFrame, count: int, *keys: str):
    """``frame`` grouped by ``keys`` in up to ``count`` tasks: their work is far more than their
    bytes, by which adaptive execution would merge them."""
    most = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(max(1, min(count, most)), *keys).groupBy(*keys)


def near_duplicates(
    frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per row of ``frame``: vec_id, n_links, component_id, kept.

    Rows link at a cosine of THRESHOLD or more in double precision. Equal vectors are one
    class with a count, so copies are never expanded into pairs; every copy counts as a link.
    Vectors of a cell are compared with each other, and those of two cells where their margins
    from the border allow a link, so no pair is missed. Vectors that are null, zero or hold null
    or non-finite components, and vectors of unequal length, link with nothing: no links, their
    own id as component, kept. Cells are compared in pairs of blocks, each a group of its own
    whose two blocks travel as rows of bytes. A null vec_id stays null and is never a
    component's id while another is there. An empty table gives no rows.
    """
    key = F.md5(F.col(vector_col).cast("array<double>").cast("string"))
    keyed = usable_rows(frame.withColumn("__v", F.col(vector_col)), id_col, "__v").withColumn(
        "key", F.md5(F.col("v").cast("string"))
    )
    classes = staged(
        keyed.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.first("v").alias("v"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "vector-classes",
    )
    cells = _fit_cells(classes)
    # Components travel as wide as the column has them.
    kind = "float32" if frame.select(vector_col).dtypes[0][1] == "array<float>" else "float64"
    members = staged(
        classes.select("cid", "n", "v").mapInPandas(
            _assign(cells, kind), "cid long, n long, width int, cell int, v binary"
        ),
        "cell-members",
    )
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("width")))))
    sizes = members.groupBy("width", "cell").agg(F.count("*").alias("n"))
    blocks = staged(
        sizes.select("width", "cell", F.ceil(F.col("n") / most).cast("int").alias("blocks")), "cell-blocks"
    )
    count = blocks.agg(F.sum("blocks")).first()[0] or 0
    packed = _dealt(
        members.join(blocks, ["width", "cell"]).withColumn(
            "block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
        ),
        count, "width", "cell", "block",
    ).applyInPandas(_pack, "width int, cell int, block int, cids binary, ns binary, vs binary")
    sent = packed.mapInPandas(
        _send(cells),
        "width int, cell int, other int, block int, cids binary, ns binary, ms binary, vs binary",
    )
    tasks = _tasks(sent, blocks)
    found = staged(
        _dealt(tasks, count * (count + 1) // 2, "width", "low", "high", "i", "j").applyInPandas(
            _compare, "cid long, links long, other long"
        ),
        "vector-links",
    )
    roots = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    totals = found.groupBy("cid").agg(F.sum("links").alias("links"))
    rooted = (
        classes.drop("v")
        .join(totals, "cid", "left")
        .join(roots, F.col("cid") == F.col("node"), "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root", "cid").alias("root"),
            "first_id",
        )
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_key = rooted.join(least, "root").select("key", "n_links", "component_id")
    rows = frame.select(
        F.col(id_col).cast("long").alias("vec_id"),
        key.alias("key"),
    )
    joined = rows.join(by_key, "key", "left")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0))
