"""Read-only graph traversals, built step by step into a DataFrame plan.

``GraphClient(vertices, edges).query(lambda g: g.V().out("calls"))`` returns
elements; steps that transform are available on the source itself (``client.g``).
A traverser is a row: ``id``, ``label``, ``source_id``, ``target_id``,
``attributes``, the ``path`` of ids, ``came_from`` (the vertex an edge was left from)
and ``marks``, the ids that ``as_`` gave a name to.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TraversalError(ValueError):
    """A traversal that can't be run."""


class MutationError(TraversalError):
    """A step that mutates graph state."""


class UnsupportedStepError(TraversalError):
    """A step the client doesn't know."""


class StepKindError(TraversalError):
    """A step that doesn't apply to what the one before gives."""


class ClosedClientError(RuntimeError):
    """The client was closed."""


# ---- fixed values: steps that mutate, refused by name
MUTATING = frozenset({"addV", "addE", "drop", "mergeV", "mergeE", "property"})
# ---- end of fixed values
_ROW = ("id", "label", "source_id", "target_id", "attributes", "path", "came_from", "marks")
_NO_MARKS = "cast(map() as map<string, string>)"


class P:
    """Predicates on values."""

    def __init__(self, test: Callable[[Column], Column]) -> None:
        self.test = test

    @staticmethod
    def eq(x: object) -> P:
        return P(lambda c: c == str(x))

    @staticmethod
    def neq(x: object) -> P:
        return P(lambda c: c != str(x))

    @staticmethod
    def within(*xs: object) -> P:
        return P(lambda c: c.isin(*map(str, xs)))

    @staticmethod
    def without(*xs: object) -> P:
        return P(lambda c: ~c.isin(*map(str, xs)))

    @staticmethod
    def gt(x: float) -> P:
        return P(lambda c: c.try_cast("double") > x)

    @staticmethod
    def gte(x: float) -> P:
        return P(lambda c: c.try_cast("double") >= x)

    @staticmethod
    def lt(x: float) -> P:
        return P(lambda c: c.try_cast("double") < x)

    @staticmethod
    def lte(x: float) -> P:
        return P(lambda c: c.try_cast("double") <= x)


def _test(value: object) -> Callable[[Column], Column]:
    return value.test if isinstance(value, P) else P.eq(value).test


class _Anonymous:
    """``__.out("calls")``: steps for sub-traversals, run later from each traverser."""

    def __init__(self, steps: tuple = ()) -> None:
        self._steps = steps

    def __getattr__(self, name: str) -> Callable[..., _Anonymous]:
        if name.startswith("__"):
            raise AttributeError(name)
        return lambda *args, **kw: _Anonymous((*self._steps, (name, args, kw)))


__ = _Anonymous()


class Traversal:
    """A traversal so far; each step returns a new one."""

    def __init__(self, vertices: DataFrame, edges: DataFrame, rows: DataFrame | None = None, kind: str | None = None, steps: tuple[str, ...] = (), last: tuple | None = None, order: tuple = ()) -> None:
        self._v, self._e, self.rows, self.kind, self.steps, self._last, self._order = vertices, edges, rows, kind, steps, last, order

    def __getattr__(self, name: str) -> object:
        if name in MUTATING:
            raise MutationError(f"step {len(self.steps) + 1}, {name}: mutates graph state")
        if name.startswith("_"):
            raise AttributeError(name)
        raise UnsupportedStepError(f"step {len(self.steps) + 1}, {name}: not supported")

    def _next(self, step: str, rows: DataFrame, kind: str | None = None, last: tuple | None = None, order: tuple = ()) -> Traversal:
        return Traversal(self._v, self._e, rows, kind or self.kind, (*self.steps, step), last, order)

    def _need(self, step: str, kind: str) -> DataFrame:
        if self.rows is None:
            raise StepKindError(f"{step}: a traversal starts with V or E")
        if self.kind != kind:
            raise StepKindError(f"step {len(self.steps) + 1}, {step}: needs a {kind}, not a {self.kind}")
        return self.rows

    # ---- start
    def _start(self, step: str, table: DataFrame, ids: tuple) -> Traversal:
        if self.rows is not None:
            raise StepKindError(f"{step}: only at the start")
        rows = table.where(F.col("id").isin(*ids)) if ids else table
        rows = rows.select("id", "label", "source_id", "target_id", "attributes", F.array("id").alias("path"), F.lit(None).cast("string").alias("came_from"), F.expr(_NO_MARKS).alias("marks"))
        return self._next(step, rows, "vertex" if step == "V" else "edge")

    def V(self, *ids: str) -> Traversal:
        return self._start("V", self._v, ids)

    def E(self, *ids: str) -> Traversal:
        return self._start("E", self._e, ids)

    # ---- navigation
    def _edges(self, step: str, near: str, labels: tuple) -> DataFrame:
        t = self._need(step, "vertex").select(F.col("id").alias("_at"), F.col("path").alias("_path"), "marks")
        e = self._e.where(F.col("label").isin(*labels)) if labels else self._e
        joined = t.join(e, t["_at"] == e[near])
        return joined.select("id", "label", "source_id", "target_id", "attributes", F.concat("_path", F.array("id")).alias("path"), F.col("_at").alias("came_from"), "marks")

    def outE(self, *labels: str) -> Traversal:
        return self._next("outE", self._edges("outE", "source_id", labels), "edge")

    def inE(self, *labels: str) -> Traversal:
        return self._next("inE", self._edges("inE", "target_id", labels), "edge")

    def bothE(self, *labels: str) -> Traversal:
        return self._next("bothE", self._edges("bothE", "source_id", labels).unionAll(self._edges("bothE", "target_id", labels)), "edge")

    def _ends(self, step: str, to: Column, keep_edge: bool = True) -> DataFrame:
        path = F.col("path") if keep_edge else F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0)))
        t = self._need(step, "edge").select(to.alias("_to"), path.alias("_path"), "marks")
        joined = t.join(self._v, t["_to"] == self._v["id"])
        return joined.select("id", "label", "source_id", "target_id", "attributes", F.concat("_path", F.array("id")).alias("path"), F.lit(None).cast("string").alias("came_from"), "marks")

    def outV(self) -> Traversal:
        return self._next("outV", self._ends("outV", F.col("source_id")), "vertex")

    def inV(self) -> Traversal:
        return self._next("inV", self._ends("inV", F.col("target_id")), "vertex")

    def bothV(self) -> Traversal:
        return self._next("bothV", self._ends("bothV", F.col("source_id")).unionAll(self._ends("bothV", F.col("target_id"))), "vertex")

    def _other(self) -> Column:
        return F.when(F.col("came_from") == F.col("source_id"), F.col("target_id")).otherwise(F.col("source_id"))

    def otherV(self) -> Traversal:
        self._need("otherV", "edge")
        return self._next("otherV", self._ends("otherV", self._other()), "vertex")

    def _hop(self, step: str, edges: Traversal, to: Column) -> Traversal:
        return self._next(step, edges._ends(step, to, keep_edge=False), "vertex")

    def out(self, *labels: str) -> Traversal:
        self._need("out", "vertex")
        return self._hop("out", self.outE(*labels), F.col("target_id"))

    def in_(self, *labels: str) -> Traversal:
        self._need("in", "vertex")
        return self._hop("in", self.inE(*labels), F.col("source_id"))

    def both(self, *labels: str) -> Traversal:
        self._need("both", "vertex")
        one, two = self._hop("both", self.outE(*labels), F.col("target_id")), self._hop("both", self.inE(*labels), F.col("source_id"))
        return self._next("both", one.rows.unionAll(two.rows), "vertex")

    # ---- filters
    def _where(self, step: str, condition: Column) -> Traversal:
        if self.rows is None:
            raise StepKindError(f"{step}: a traversal starts with V or E")
        return self._next(step, self.rows.where(condition), order=self._order)

    @staticmethod
    def _value(key: str) -> Column:
        return F.try_element_at("attributes", F.lit(key))["v"]

    def has(self, key: str, value: object = None) -> Traversal:
        c = self._value(key)
        return self._where("has", c.isNotNull() if value is None else _test(value)(c))

    def hasNot(self, key: str) -> Traversal:
        return self._where("hasNot", self._value(key).isNull())

    def hasKey(self, *keys: str) -> Traversal:
        return self._where("hasKey", reduce(lambda a, b: a | b, [F.map_contains_key("attributes", k) for k in keys]))

    def hasValue(self, *values: object) -> Traversal:
        return self._where("hasValue", F.exists(F.map_values("attributes"), lambda x: x["v"].isin(*map(str, values))))

    def hasId(self, *ids: str) -> Traversal:
        return self._where("hasId", F.col("id").isin(*ids))

    def hasLabel(self, *labels: str) -> Traversal:
        return self._where("hasLabel", F.col("label").isin(*labels))

    def is_(self, value: object) -> Traversal:
        return self._where("is", _test(value)(F.col("id")))

    def _apply(self, steps: tuple) -> Traversal:
        t = self
        for name, args, kw in steps:
            t = getattr(t, name)(*args, **kw)
        return t

    def _matching(self, sub: _Anonymous) -> DataFrame:
        """Ids of traversers from which a sub-traversal finds something."""
        seeds = self.rows.select("id").distinct().join(self._v if self.kind == "vertex" else self._e, "id")
        start = seeds.select("id", "label", "source_id", "target_id", "attributes", F.array("id").alias("path"), F.lit(None).cast("string").alias("came_from"), F.expr(_NO_MARKS).alias("marks"))
        found = Traversal(self._v, self._e, start, self.kind, ("V",))._apply(sub._steps)
        return found.rows.select(F.get("path", 0).alias("id")).distinct()

    def filter(self, condition: _Anonymous | Column) -> Traversal:
        return self.where(condition)

    def where(self, condition: _Anonymous | Column) -> Traversal:
        if isinstance(condition, Column):
            return self._where("where", condition)
        return self._next("where", self.rows.join(self._matching(condition), "id", "left_semi").select(*_ROW))

    def not_(self, sub: _Anonymous) -> Traversal:
        return self._next("not", self.rows.join(self._matching(sub), "id", "left_anti").select(*_ROW))

    def and_(self, *subs: _Anonymous) -> Traversal:
        return reduce(lambda t, s: t.where(s), subs, self)

    def or_(self, *subs: _Anonymous) -> Traversal:
        found = reduce(lambda a, b: a.unionAll(b), [self._matching(s) for s in subs]).distinct()
        return self._next("or", self.rows.join(found, "id", "left_semi").select(*_ROW))

    def simplePath(self) -> Traversal:
        return self._where("simplePath", F.size(F.array_distinct("path")) == F.size("path"))

    def cyclicPath(self) -> Traversal:
        return self._where("cyclicPath", F.size(F.array_distinct("path")) < F.size("path"))

    # ---- names
    def as_(self, *names: str) -> Traversal:
        """Names for the element a traverser is on; a name given again is that of the later element."""
        if self.rows is None:
            raise StepKindError("as: a traversal starts with V or E")
        kept = F.map_filter("marks", lambda k, _: ~k.isin(*names))
        own = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col("id")] * len(names)))
        return self._next("as", self.rows.withColumn("marks", F.map_concat(kept, own)), last=self._last, order=self._order)

    def _at(self, name: str) -> Traversal:
        """Traversers moved to the vertex of a name."""
        t = self.rows.select(F.try_element_at("marks", F.lit(name)).alias("_at"), "path", "marks")
        rows = t.join(self._v, t["_at"] == self._v["id"]).withColumn("came_from", F.lit(None).cast("string"))
        return self._next("match", rows.select(*_ROW), "vertex")

    def match(self, *patterns: _Anonymous) -> Traversal:
        """Patterns ``__.as_("a").out("calls").as_("b")`` that hold together, their names bound in ``marks``.

        The first pattern's first name is the element a traverser is on.  Each
        other pattern starts from a name that is bound already; one that ends in a
        bound name holds where it leads there.
        """
        self._need("match", "vertex")
        split = []
        for p in patterns:
            steps = p._steps
            if len(steps) < 2 or steps[0][0] != "as_" or len(steps[0][1]) != 1:
                raise StepKindError("match: a pattern is as_(name), steps, and perhaps as_(name)")
            end = steps[-1][1][0] if steps[-1][0] == "as_" else None
            split.append((steps[0][1][0], steps[1:-1] if end else steps[1:], end))
        if not split:
            raise StepKindError("match: no pattern")
        t, bound = self.as_(split[0][0]), {split[0][0]}
        while split:
            ready = next((x for x in split if x[0] in bound), None)
            if ready is None:
                raise StepKindError(f"match: nothing leads to {sorted({x[0] for x in split})}")
            split.remove(ready)
            start, steps, end = ready
            if end is None:  # only has to find something
                found = t._at(start)._matching(_Anonymous(steps)).select(F.col("id").alias("_found"))
                rows = t.rows.join(found, F.try_element_at(t.rows["marks"], F.lit(start)) == found["_found"], "left_semi")
                t = t._next("match", rows)
                continue
            t = t._at(start)._apply(steps)
            t = t._where("match", F.col("id") == F.try_element_at("marks", F.lit(end))) if end in bound else t.as_(end)
            bound.add(end)
        return t._next("match", t.rows)

    # ---- order and number
    def dedup(self, key: str | None = None) -> Traversal:
        rows = self.rows.withColumn("_key", self._value(key) if key else F.col("id")).dropDuplicates(["_key"]).drop("_key")
        return self._next("dedup", rows, last=("dedup", self))

    def _sorted(self, step: str, before: Traversal, keys: tuple, last: tuple) -> Traversal:
        """``keys``: attribute (or ``id``, ``label``) and whether it descends; ids decide ties."""
        return self._next(step, before.rows.orderBy(*self._sort((*keys, ("id", False)))), last=last, order=keys)

    def _sort(self, keys: tuple, back: bool = False) -> list[Column]:
        """Nulls come last, or in the order backwards first."""
        column = lambda k: F.col(k) if k in ("id", "label") else self._value(k)
        if back:
            return [column(k).asc_nulls_first() if down else column(k).desc_nulls_first() for k, down in keys]
        return [column(k).desc_nulls_last() if down else column(k).asc_nulls_last() for k, down in keys]

    def order(self, descending: bool = False) -> Traversal:
        return self._sorted("order", self, (("id", descending),), ("order", self, ()))

    def by(self, key: str, descending: bool = False) -> Traversal:
        """Attribute (or ``id``, ``label``) for the order or dedup before it; of several for an order the first counts most."""
        what, before, *keys = self._last or ("", self)
        if what == "dedup":
            return before.dedup(key)
        if what != "order":
            raise StepKindError(f"step {len(self.steps) + 1}, by: nothing before takes it")
        sort = (*keys[0], (key, descending))
        return self._sorted("by", before, sort, ("order", before, sort))

    def limit(self, n: int) -> Traversal:
        return self._next("limit", self.rows.limit(n), order=self._order)

    def skip(self, n: int) -> Traversal:
        return self._next("skip", self.rows.offset(n), order=self._order)

    def range_(self, low: int, high: int) -> Traversal:
        return self._next("range", self.rows.offset(low).limit(high - low) if high >= 0 else self.rows.offset(low), order=self._order)

    def tail(self, n: int = 1) -> Traversal:
        """The last ``n`` by id, or by the order before it; they come in that order."""
        keys = (*self._order, ("id", False))
        rows = self.rows.orderBy(*self._sort(keys, back=True)).limit(n)
        return self._next("tail", rows.orderBy(*self._sort(keys)), order=self._order)

    def sample(self, n: int, seed: int = 7) -> Traversal:
        return self._next("sample", self.rows.orderBy(F.rand(seed)).limit(n))

    def coin(self, p: float, seed: int = 7) -> Traversal:
        return self._next("coin", self.rows.where(F.rand(seed) < p))

    def shuffle(self, seed: int = 7) -> Traversal:
        return self._next("shuffle", self.rows.orderBy(F.rand(seed)))

    def identity(self) -> Traversal:
        return self._next("identity", self.rows, order=self._order)

    def barrier(self) -> Traversal:
        """A traversal is evaluated set by set anyway."""
        return self._next("barrier", self.rows, order=self._order)

    # ---- transforming steps (not for typed queries): they end in plain DataFrames
    def id_(self) -> DataFrame:
        return self.rows.select("id")

    def label(self) -> DataFrame:
        return self.rows.select("label")

    def constant(self, value: object) -> DataFrame:
        return self.rows.select(F.lit(value).alias("value"))

    def values(self, *keys: str) -> DataFrame:
        return self.properties(*keys).select("value")

    def properties(self, *keys: str) -> DataFrame:
        rows = self.rows.select("id", F.explode("attributes").alias("key", "x")).select("id", "key", F.col("x.v").alias("value"))
        return rows.where(F.col("key").isin(*keys)) if keys else rows

    value = values

    def key(self, *keys: str) -> DataFrame:
        return self.properties(*keys).select("key")

    def valueMap(self, *keys: str) -> DataFrame:
        kept = F.map_filter("attributes", lambda k, _: k.isin(*keys)) if keys else F.col("attributes")
        return self.rows.select(F.transform_values(kept, lambda _, x: x["v"]).alias("value_map"))

    propertyMap = valueMap

    def elementMap(self) -> DataFrame:
        return self.rows.select("id", "label", "source_id", "target_id", F.transform_values("attributes", lambda _, x: x["v"]).alias("attributes"))

    def project(self, **keys: str) -> DataFrame:
        pick = lambda k: F.col(k) if k in ("id", "label") else self._value(k)
        return self.rows.select(*[pick(k).alias(name) for name, k in keys.items()])

    def select(self, *names: str) -> DataFrame:
        """A column for each name that ``as_`` gave, with the element's id; null where a traverser has no such name."""
        return self.rows.select(*[F.try_element_at("marks", F.lit(n)).alias(n) for n in names])

    def path(self) -> DataFrame:
        return self.rows.select("path")

    def count(self) -> DataFrame:
        return self.rows.agg(F.count(F.lit(1)).alias("count"))

    def _number(self, key: str) -> Column:
        return self._value(key).try_cast("double")

    def sum_(self, key: str) -> DataFrame:
        return self.rows.agg(F.sum(self._number(key)).alias("sum"))

    def min_(self, key: str) -> DataFrame:
        return self.rows.agg(F.min(self._number(key)).alias("min"))

    def max_(self, key: str) -> DataFrame:
        return self.rows.agg(F.max(self._number(key)).alias("max"))

    def mean(self, key: str) -> DataFrame:
        return self.rows.agg(F.avg(self._number(key)).alias("mean"))

    def numbers(self, key: str) -> DataFrame:
        """Sum, least, greatest and mean at once."""
        n = self._number(key)
        return self.rows.agg(F.sum(n).alias("sum"), F.min(n).alias("min"), F.max(n).alias("max"), F.avg(n).alias("mean"))

    def math(self, expression: Callable[[Column], Column], key: str) -> DataFrame:
        return self.rows.select("id", expression(self._number(key)).alias("value"))

    def groupCount(self, key: str = "label") -> DataFrame:
        c = F.col(key) if key in ("id", "label") else self._value(key)
        return self.rows.groupBy(c.alias("key")).agg(F.count(F.lit(1)).alias("n"))

    def group(self, key: str = "label") -> DataFrame:
        c = F.col(key) if key in ("id", "label") else self._value(key)
        return self.rows.groupBy(c.alias("key")).agg(F.array_sort(F.collect_list("id")).alias("ids"))

    def fold(self) -> DataFrame:
        return self.rows.agg(F.array_sort(F.collect_list("id")).alias("ids"))

    @staticmethod
    def unfold(folded: DataFrame, column: str = "ids") -> DataFrame:
        return folded.select(F.explode(column).alias("value"))

    def tree(self) -> DataFrame:
        """Edges of the tree of all paths: depth, parent prefix, child."""
        steps = self.rows.select(F.posexplode("path").alias("depth", "id"), "path")
        return steps.select("depth", F.array_join(F.slice("path", 1, F.col("depth")), "/").alias("parent"), "id").distinct()

    def sack(self, start: float, fold: Callable[[Column, Column], Column], key: str) -> DataFrame:
        return self.rows.select("id", fold(F.lit(start), self._number(key)).alias("sack"))

    def flatMap(self, fn: Callable[[Traversal], Traversal]) -> Traversal:
        return fn(self)

    map_ = flatMap


def reachable(vertices: DataFrame, edges: DataFrame, start: list[str], hops: int, *labels: str) -> DataFrame:
    """Ids reached from ``start`` in at most ``hops`` steps with their least distance; an extension to the typed steps."""
    e = edges.where(F.col("label").isin(*labels)) if labels else edges
    front = vertices.where(F.col("id").isin(*start)).select("id", F.lit(0).alias("distance"))
    seen = front
    for n in range(1, hops + 1):
        front = front.join(e, F.col("source_id") == front["id"]).select(F.col("target_id").alias("id")).distinct()
        front = front.join(vertices.select("id"), "id", "left_semi").join(seen.select("id"), "id", "left_anti").withColumn("distance", F.lit(n))
        seen = seen.unionByName(front)
    return seen


def tables(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(vertices, edges)`` in the traversal's shape, from merged elements."""
    rows = elements.select(F.col("element_id").alias("id"), F.col("type").alias("label"), "source_id", "target_id", "attributes", "kind")
    return rows.where(F.col("kind") == "node").drop("kind"), rows.where(F.col("kind") == "edge").drop("kind")


class GraphClient:
    """Typed queries over vertex and edge tables; a context manager, closing twice does no harm."""

    def __init__(self, vertices: DataFrame, edges: DataFrame) -> None:
        self._tables, self.closed = (vertices, edges), False

    def __enter__(self) -> GraphClient:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        self.closed = True

    @property
    def g(self) -> Traversal:
        if self.closed:
            raise ClosedClientError("the client is closed")
        return Traversal(*self._tables)

    def query(self, build: Callable[[Traversal], Traversal]) -> DataFrame:
        """Elements (id, label, endpoints, attributes) that a traversal of typed steps ends on."""
        found = build(self.g)
        if not isinstance(found, Traversal) or found.rows is None:
            raise TraversalError("the callback has to return a traversal that starts with V or E")
        return found.elementMap()

