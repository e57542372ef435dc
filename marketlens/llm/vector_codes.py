"""Codes of vectors by part: each part is replaced by the number of an entry of its codebook.

Codebooks are refined in rounds: every part goes to its nearest entry, and an entry becomes the mean of its parts, all in
whole numbers. Parts are not compared with all entries. Tasks build a metric tree over the parts they hold, once, by the
anchors hierarchy: anchors are chosen far from each other and take the points that are nearer to them than to any other,
skipping by the triangle inequality what cannot change; then anchors are merged, the pair with the smallest common ball
first, up to a root, and cut up in the same way, down to leaves. A ball caches the sum and the number of its points. A
round walks down the trees with the list of entries that may own points of a ball: a ball inherits its parent's list and
strikes off the entries that are farther than the nearest one by more than its diameter. When one is left the ball is
owned whole, and its sum and number are all that is added; only leaves with several entries left look at their points.
Sums of entries are all that leaves a task.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stored
from .nearest import as_matrix

#: Vectors under one set of trees, and points of a leaf.
CHUNK, LEAF = 8_192, 48
#: Scaled components are kept below this in absolute value, and a part has this many at most: squared distances stay
#: whole numbers below 2^53.
LARGEST, WIDEST = 1 << 20, 2_048
#: Labels that are sent to all workers; more are joined by shuffle, each split into SALTS.
FEW_LABELS, SALTS = 100_000, 16


# ------------------------------------------------------------------------ trees


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def anchors(points: np.ndarray, how_many: int) -> list[np.ndarray]:
    """Rows of `points` by their anchor. The next anchor is the point farthest from its own in the widest ball; it asks
    only points that are at least half as far from their anchor as the anchors are from each other."""
    first = _distances(points, points[0])
    order = np.argsort(-first, kind="stable")
    own, far, centre = [order], [first[order]], [points[0]]
    while len(own) < how_many:
        radius = [d[0] if len(d) else 0.0 for d in far]
        widest = int(np.argmax(radius))
        if radius[widest] == 0:
            break
        new = points[own[widest][0]]
        taken, away = [], []
        for k in range(len(own)):
            apart = float(np.sqrt(((new - centre[k]) ** 2).sum()))
            # points nearer to their anchor than this cannot be nearer to the new one; rows are in falling order
            ask = int(np.searchsorted(-far[k], -apart / 2, "right"))
            if not ask:
                continue
            d = _distances(points[own[k][:ask]], new)
            moves = d < far[k][:ask]
            if moves.any():
                taken.append(own[k][:ask][moves])
                away.append(d[moves])
                stay = np.concatenate([~moves, np.ones(len(own[k]) - ask, bool)])
                own[k], far[k] = own[k][stay], far[k][stay]
        row, d = np.concatenate(taken), np.concatenate(away)
        order = np.argsort(-d, kind="stable")
        own.append(row[order])
        far.append(d[order])
        centre.append(new)
    return [x for x in own if len(x)]


class Tree:
    """Balls over points, the root first. A ball's points are a stretch of `order`."""

    def __init__(self, points: np.ndarray):
        self.low, self.high, self.left, self.right, self.centre, self.radius, self.sum = [], [], [], [], [], [], []
        self.points = points.astype(np.float64)
        order: list[np.ndarray] = []
        self._place(self._build(np.arange(len(points))), order, 0)
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.low, self.high, self.left, self.right = (np.array(x, np.int32) for x in (self.low, self.high, self.left, self.right))
        self.centre, self.radius, self.sum = np.array(self.centre), np.array(self.radius), np.array(self.sum, np.int64)
        del self.points

    def _build(self, rows: np.ndarray):
        """A leaf as its rows, or a pair."""
        if len(rows) <= LEAF:
            return rows
        some = self.points[rows]
        groups = anchors(some, max(2, int(np.sqrt(len(rows)))))
        if len(groups) < 2:  # all alike
            return rows
        return self._merged([self._build(rows[g]) for g in groups], [some[g] for g in groups])

    @staticmethod
    def _merged(parts: list, points: list[np.ndarray]):
        """Pairs of parts put together, those with the smallest common ball first, until one is left."""
        n = len(parts)
        count = np.array([len(p) for p in points], np.float64)
        mean = np.array([p.mean(axis=0) for p in points])
        radius = np.array([_distances(p, m).max() for p, m in zip(points, mean, strict=True)])
        apart = np.sqrt(((mean[:, None] - mean[None]) ** 2).sum(axis=2))
        cost = (apart + radius[:, None] + radius[None]) / 2
        np.fill_diagonal(cost, np.inf)
        for _ in range(n - 1):
            i, j = divmod(int(cost.argmin()), n)
            parts[i], parts[j] = (parts[i], parts[j]), None
            both = count[i] + count[j]
            centre = (count[i] * mean[i] + count[j] * mean[j]) / both
            # holds both balls, whatever is in them
            radius[i] = max(np.sqrt(((centre - mean[k]) ** 2).sum()) + radius[k] for k in (i, j))
            mean[i], count[i] = centre, both
            cost[j], cost[:, j] = np.inf, np.inf
            live = np.isfinite(cost[i])
            live[i] = False
            d = np.sqrt(((mean[live] - centre) ** 2).sum(axis=1))
            cost[i, live] = cost[live, i] = (d + radius[live] + radius[i]) / 2
        return next(p for p in parts if p is not None)

    def _place(self, part, order: list[np.ndarray], begin: int) -> int:
        """Number a ball and those in it; where its points end. Without recursion: a merged tree may be deep."""
        stack, ends = [(part, -1, False)], {}
        at = begin
        while stack:
            what, parent, right = stack.pop()
            if what is None:  # all that is in ball `parent` has been placed
                k = parent
                self.high[k] = at
                rows = np.concatenate([order[i] for i in range(ends[k], len(order))])
                own = self.points[rows]
                total = own.sum(axis=0)
                centre = total / len(own)
                self.sum[k], self.centre[k] = total.astype(np.int64), centre
                self.radius[k] = float(_distances(own, centre).max())
                continue
            k = len(self.low)
            for x, v in ((self.low, at), (self.high, at), (self.left, -1), (self.right, -1), (self.centre, None), (self.radius, 0.0), (self.sum, None)):
                x.append(v)
            if parent >= 0:
                (self.right if right else self.left)[parent] = k
            ends[k] = len(order)
            stack.append((None, k, False))
            if isinstance(what, tuple):
                stack += [(what[1], k, True), (what[0], k, False)]
            else:
                order.append(what)
                at += len(what)
        return at

    def owners(self, points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(balls, -, entry) for balls that one entry owns whole, then (-, points, entry) for the points of the rest."""
        n = len(entries)
        scale = 1e-9 * (1 + float(np.abs(entries).max(initial=0)) + float(np.abs(self.centre).max(initial=0)))
        none = np.zeros(0, np.int64)
        ball, may = np.zeros(1, np.int64), np.ones((1, n), bool)
        open_, lists = [], []
        while len(ball):
            centre = self.centre[ball]
            d = np.sqrt(np.maximum((centre**2).sum(axis=1)[:, None] - 2 * centre @ entries.T + (entries**2).sum(axis=1), 0))
            # the matrix product rounds by more than a difference does
            slack = np.sqrt(scale * (1 + d.max(axis=1)))
            best = np.where(may, d, np.inf).min(axis=1)
            may &= d <= (best + 2 * self.radius[ball] + slack)[:, None]
            single = may.sum(axis=1) == 1
            if single.any():
                yield ball[single], none, may[single].argmax(axis=1)
            leaf = ~single & (self.left[ball] < 0)
            open_.append(ball[leaf])
            lists.append(may[leaf])
            inner = ~single & ~leaf
            ball, may = np.concatenate([self.left[ball[inner]], self.right[ball[inner]]]), np.concatenate([may[inner], may[inner]])
        ball, may = np.concatenate(open_), np.concatenate(lists)
        for first in range(0, len(ball), 64):
            some = ball[first : first + 64]
            size = self.high[some] - self.low[some]
            row = np.concatenate([self.order[a:b] for a, b in zip(self.low[some].tolist(), self.high[some].tolist(), strict=True)])
            squared = squares(points[row], entries)
            squared[~np.repeat(may[first : first + 64], size, axis=0)] = np.inf
            yield none, row, squared.argmin(axis=1)  # the first of equals: the smaller number


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact: whole numbers below 2^53 in doubles."""
    p = points.astype(np.float64)
    return (p**2).sum(axis=1)[:, None] - 2 * (p @ entries.T) + (entries**2).sum(axis=1)


def _packed(tree: Tree) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{k: getattr(tree, k) for k in ("low", "high", "left", "right", "centre", "radius", "sum", "order")})
    return out.getvalue()


def _unpacked(data: bytes) -> Tree:
    tree = object.__new__(Tree)
    with np.load(io.BytesIO(data)) as held:
        for k in held.files:
            setattr(tree, k, held[k])
    return tree


# ------------------------------------------------------------------------ codes


def usable(vector: Column, length: int) -> Column:
    """As long as asked, and all components numbers that can be scaled and summed exactly."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / 1024))
    return (F.size(vector) == length) & fits


def _scaled(vectors: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    return np.floor(as_matrix(vectors).reshape(-1, length) * 1024).astype(np.int64)


def encode(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, code, error, label_error) of every vector that is kept, and the codebooks by part, entry and component.

    A component x counts as floor(1024 * x). The codebook of a part starts as that part of the vectors with the smallest
    ids, ties to the vector that is less. Each round gives every part to its nearest entry, ties to the smaller number,
    and makes an entry the mean of its parts, rounded down; an entry without parts stays. The code has two hexadecimal
    digits a part; `error` adds up the squared distances of the parts, and `label_error` the errors of a label's vectors,
    those without label together.

    Vectors that are null, or hold null or non-finite components or ones of 1,024 and more in absolute value (they could not be compared
    exactly),
    are dropped; so are rows without id and vectors of another length than the first kept one by id. That length has to
    be a multiple of `parts`. Rows that repeat an id are rows of their own. With fewer vectors than entries there are as
    many entries as vectors, and an empty table gives no rows and no codebooks. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[label].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull())
    some = rows.filter(usable(F.col("vector"), F.size("vector")) & (F.size("vector") > 0)).orderBy("id", "vector").select("vector").limit(1).collect()
    length = len(some[0]["vector"]) if some else parts
    if length % parts or length > parts * WIDEST:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} parts of up to {WIDEST}")
    width = length // parts
    rows = rows.filter(usable(F.col("vector"), length))
    start = rows.orderBy("id", "vector").select("vector").limit(entries).collect()
    books = np.floor(np.array([r["vector"] for r in start], np.float64).reshape(len(start), parts, width) * 1024).transpose(1, 0, 2)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of up to CHUNK vectors: ids, labels, components and a tree for each part."""
        for held in _chunks(batches):
            points = _scaled(held["vector"], length)
            trees = [_packed(Tree(points[:, p * width : (p + 1) * width])) for p in range(parts)]
            whole = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), x.cast(t) if t else x)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    whole(held["id"].combine_chunks(), pa.int64()),
                    whole(held["label"].combine_chunks(), None),
                    pa.array([points.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([trees], pa.list_(pa.binary())),
                ],
                names=["ids", "labels", "points", "trees"],
            )

    planted = stored(rows.mapInArrow(plant, f"ids array<long>, labels array<{kind}>, points binary, trees array<binary>"))

    for _ in range(rounds if len(start) else 0):
        books = _next_books(planted, books, width)
    known = spark.sparkContext.broadcast(books)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).reshape(-1, length)
                code, error = np.zeros((len(points), parts), np.int64), np.zeros(len(points), np.int64)
                for p, data in enumerate(batch.column("trees")[i].as_py()):
                    own, book = points[:, p * width : (p + 1) * width].astype(np.int64), known.value[p]
                    tree = _unpacked(data)
                    for ball, row, entry in tree.owners(own, book):
                        code[row, p] = entry if len(row) else code[row, p]
                        for k, e in zip(ball.tolist(), entry.tolist(), strict=False):
                            code[tree.order[tree.low[k] : tree.high[k]], p] = e
                    error += ((own - book[code[:, p]].astype(np.int64)) ** 2).sum(axis=1)
                digits = ["".join(f"{x:02x}" for x in c) for c in code.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(digits), pa.array(error)], names=["id", "label", "code", "error"]
                )

    coded = stored(planted.mapInArrow(give, f"id long, label {kind}, code string, error long"))
    return _with_label_errors(coded).select(F.col("id").alias(vec_id), "code", "error", "label_error"), books


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, CHUNK - size)
            batch = batch.slice(part.num_rows)
            held.append(part)
            size += part.num_rows
            if size == CHUNK:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _next_books(planted: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Codebooks after a round: every entry the mean of its parts."""
    parts, n, _ = books.shape
    known = planted.sparkSession.sparkContext.broadcast(books)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, n), np.int64), np.zeros((parts, n, width), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).reshape(-1, parts * width)
                for p, data in enumerate(batch.column("trees")[i].as_py()):
                    own, tree = points[:, p * width : (p + 1) * width].astype(np.int64), _unpacked(data)
                    for ball, row, entry in tree.owners(own, known.value[p]):
                        np.add.at(count[p], entry, tree.high[ball] - tree.low[ball] if len(ball) else 1)
                        np.add.at(total[p], entry, tree.sum[ball] if len(ball) else own[row])
        p, e = np.nonzero(count)
        if len(p):
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(p) * width + 1, width), pa.int32()), pa.array(total[p, e].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), flat], names=["part", "entry", "n", "total"])

    sums = planted.select("points", "trees").mapInArrow(add_up, "part int, entry int, n long, total array<long>")
    sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(width)])
    books = books.copy()
    for r in sums.collect():  # a row for each entry
        books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    known.unpersist()
    return books


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds up the errors of a label before anything is shuffled; a label of very many vectors is joined in parts."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    if sums.count() <= FEW_LABELS:
        same = coded["label"].eqNullSafe(sums["label"])
        return coded.join(F.broadcast(sums), same).drop(sums["label"])
    sums = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("label", "its")
    dealt = coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    return dealt.join(sums, (dealt["salt"] == sums["salt"]) & dealt["label"].eqNullSafe(sums["its"])).drop("its", "salt")


def digest(books: np.ndarray) -> str:
    """sha256 of all components as decimal numbers with commas between them."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()
