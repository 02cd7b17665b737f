"""Mixing sources to target weights by hierarchical budgets.

Every path domain > language > source is a leaf. A token budget goes down the tree: children share their parent's by weight, a
child never gets more than its texts hold in ``max_epochs`` readings, and what it cannot take goes to its siblings by
their weights; only what all of them together cannot take was never given to their parent, so it went to the parent's
siblings. A leaf reads its texts in seeded epochs, each in an order of its own: whole epochs first, then a prefix.

Where a leaf's prefix ends is found from sums over ranges of the order, then within the one range it falls in, so a
leaf with a third of all rows is many small ranges. Choosing rows is then a comparison with the leaf's end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.workspace import durable

# The domains of sources, and weights of nodes (1 where none is given).
DOMAINS = {"news": ("src1", "src2", "src3", "src4"), "forum": ("src5", "src6", "src7", "src8", "src9")}
OTHER_DOMAIN = "web"
DOMAIN_WEIGHTS = {"web": 5, "news": 3, "forum": 2}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS = {"src0": 3}
WEIGHTS = (DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS)
SHARE_PERCENT = 80
MAX_EPOCHS = 4
SEED = 7
RANGE_ROWS = 20_000
LEVELS = ("__domain", "__lang", "__source")


def domain_of(source: Column) -> Column:
    out = F.lit(OTHER_DOMAIN)
    for domain, sources in DOMAINS.items():
        out = F.when(source.isin(*sources), F.lit(domain)).otherwise(out)
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def _weight(level: Column, given: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in given.items():
        out = F.when(level == value, F.lit(weight)).otherwise(out)
    return out.cast("decimal(20,0)")


def share_out(children: DataFrame, parent: Sequence[str], child: str, budget: str = "budget") -> DataFrame:
    """Replace ``budget`` (the parent's) by each child's share: by ``weight``, at most ``capacity``, rounded down.

    Children are taken by how soon they fill up; the first that does not fill sets what a unit of weight is worth.
    """
    own = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = own.orderBy((F.col("capacity") / F.col("weight")).cast("double"), child)
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(20,0)")
    rest = F.col(budget) - F.coalesce(F.sum("capacity").over(ahead), zero)
    left = F.sum("weight").over(own) - F.coalesce(F.sum("weight").over(ahead), zero)
    placed = children.withColumns({"__rest": rest.cast("decimal(20,0)"), "__left": left.cast("decimal(20,0)"), "__k": F.row_number().over(order)})
    open_ = F.when(F.col("__rest") * F.col("weight") < F.col("capacity") * F.col("__left"), F.col("__k"))
    placed = placed.withColumn("__first", F.min(open_).over(own))
    at = lambda c: F.max(F.when(F.col("__k") == F.col("__first"), F.col(c))).over(own)
    placed = placed.withColumns({"__r": at("__rest"), "__l": at("__left")})
    part = F.expr("cast(__r * weight as decimal(38,0)) div __l").cast("decimal(20,0)")
    full = F.col("__first").isNull() | (F.col("__k") < F.col("__first"))
    return placed.withColumn(budget, F.when(full, F.col("capacity")).otherwise(part)).drop("__rest", "__left", "__k", "__first", "__r", "__l")


def leaf_budgets(leaves: DataFrame, budget: Column, weights: Sequence[dict[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (three level columns, ``tokens``, ``texts``) with each leaf's ``budget`` in tokens."""
    own = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast("decimal(20,0)"))
    total = own.agg(F.coalesce(F.sum("capacity"), F.lit(0)).cast("decimal(20,0)").alias("all_capacity"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens"))
    total = total.select(F.least(budget.cast("decimal(20,0)"), "all_capacity").alias("budget"))
    above = None
    for depth, name in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = own.groupBy(*path).agg(F.sum("capacity").cast("decimal(20,0)").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(F.col(name), weights[depth]))
        nodes = nodes.join(F.broadcast(total)) if above is None else _same(nodes, above, path[:-1])
        above = share_out(nodes, path[:-1], name).select(*path, "budget")
    return _same(leaves, above, list(LEVELS))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys of which null is a value."""
    renamed = right.select(*(F.col(k).alias(f"{k}_r") for k in keys), *(c for c in right.columns if c not in keys))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"{k}_r"))
    return left.join(renamed, condition).drop(*(f"{k}_r" for k in keys))


def name_of(doc_id: Column, text: Column) -> Column:
    """What a row's places hang on: its id, or its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(text.cast("string"))))


def place_in_epoch(name: Column, epoch: Column, seed: int) -> Column:
    """A row's place in the order of an epoch, as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name))


def mix_sources(
    docs: DataFrame, share_percent: int = SHARE_PERCENT, weights: Sequence[dict[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """The chosen rows of ``docs``, one for each epoch that reads them, with ``epoch``, ``n_tokens``, ``take_tokens`` and
    ``domain`` added or replaced.

    The budget is ``share_percent`` of all tokens, which are words. ``take_tokens`` is less than ``n_tokens`` only at the end of
    a leaf's prefix. Null languages and sources are values of their own; texts without words (null ones too) are never chosen.
    Rows of one id in one leaf, or without id and of one text, share a place. Where a prefix ends in such a place, its rows
    divide what is left in proportion to their tokens, rounded down, so no budget is exceeded. An empty table gives no row.
    Columns of ``docs`` may have any name that does not begin with two underscores.
    """
    source = docs.withColumns({
        LEVELS[0]: F.coalesce(domain_of(F.col(source_col)), F.lit(OTHER_DOMAIN)), LEVELS[1]: F.col(lang_col).cast("string"), LEVELS[2]: F.col(source_col).cast("string"),
        "__n": word_count(F.col(text_col).cast("string")), "__id": name_of(F.col(id_col), F.col(text_col)),
    })
    narrow = durable(source.where("__n > 0").select("__id", "__n", *LEVELS), "tokens")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("__n").alias("tokens"), F.count("*").alias("texts"))
    leaves = durable(leaves, "leaves")
    budget = F.expr(f"cast(all_tokens as decimal(20,0)) * {share_percent} div 100")
    plan = leaf_budgets(leaves, budget, weights, max_epochs).where("budget > 0").select(
        *LEVELS, F.expr("budget div tokens").cast("int").alias("whole"), F.expr("cast(budget % tokens as bigint)").alias("rest"),
        F.ceil(F.col("texts") / RANGE_ROWS).cast("bigint").alias("ranges"),
    )
    plan = durable(plan, "leaf-plan")

    keyed = _same(narrow, plan.where("rest > 0"), list(LEVELS)).withColumn("key", place_in_epoch(F.col("__id"), F.col("whole"), seed))
    part = F.call_function("shiftright", F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") * F.col("ranges"), F.lit(32))
    units = durable(keyed.withColumn("part", part).select(*LEVELS, "rest", "part", "key", "__n"), "prefix-order")
    sums = units.groupBy(*LEVELS, "part").agg(F.sum("__n").alias("held"))
    ahead = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(ahead), F.lit(0)))
    closing = _same(units, durable(sums, "range-sums").withColumnRenamed("part", "p"), list(LEVELS)).where(
        "part = p and before < rest and before + held >= rest"
    )
    closing = closing.groupBy(*LEVELS, "rest", "before", "key").agg(F.sum("__n").alias("n"))
    within = Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    closing = closing.withColumn("at", F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))).where("at < rest and at + n >= rest")
    ends = closing.select(
        *LEVELS, F.col("key").alias("__last_key"), (F.col("rest") - F.col("at")).alias("__last_take"), F.col("n").alias("__last_n")
    )
    renamed = ends.select(*(F.col(k).alias(f"{k}_e") for k in LEVELS), "__last_key", "__last_take", "__last_n")
    condition = F.lit(True)
    for k in LEVELS:
        condition = condition & F.col(k).eqNullSafe(F.col(f"{k}_e"))
    plan = plan.join(renamed, condition, "left").select(
        *LEVELS, F.col("whole").alias("__whole"), "__last_key", "__last_take", "__last_n"
    )
    plan = durable(plan, "leaf-ends")

    chosen = _same(source.where("__n > 0"), plan, list(LEVELS))
    key = place_in_epoch(F.col("__id"), F.col("__whole"), seed)
    readings = F.col("__whole") + F.when(key <= F.col("__last_key"), 1).otherwise(0)
    chosen = chosen.withColumn("__ends", F.coalesce(key == F.col("__last_key"), F.lit(False))).withColumn("__readings", readings)
    chosen = chosen.where("__readings > 0").withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__readings") - 1)))
    cut = F.col("__ends") & (F.col("__epoch") == F.col("__whole"))
    part_taken = F.expr("cast(cast(__n as decimal(19,0)) * cast(__last_take as decimal(19,0)) div __last_n as bigint)")
    chosen = chosen.withColumn("__take", F.when(cut, part_taken).otherwise(F.col("__n"))).where("__take > 0")
    return chosen.withColumns({
        "epoch": F.col("__epoch"), "n_tokens": F.col("__n"), "take_tokens": F.col("__take"), "domain": F.col("__domain")
    }).drop(*LEVELS, "__n", "__id", "__whole", "__last_key", "__last_take", "__last_n", "__ends", "__readings", "__epoch", "__take")


def _ansi() -> str:
    case = lambda col, given: f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in given.items()) + " ELSE 1 END"
    domain = "CASE " + " ".join(f"WHEN source IN ({', '.join(repr(s) for s in v)}) THEN '{k}'" for k, v in DOMAINS.items()) + f" ELSE '{OTHER_DOMAIN}' END"
    steps, above = [], None
    for depth, name in enumerate(("domain", "lang", "source")):
        path = ["domain", "lang", "source"][: depth + 1]
        parent = f"PARTITION BY {', '.join(path[:-1])}" if depth else ""
        nodes = f"SELECT {', '.join(path)}, sum(tokens)::HUGEINT * {MAX_EPOCHS} AS capacity, ({case(name, WEIGHTS[depth])})::HUGEINT AS weight FROM leaves GROUP BY {', '.join(path)}"
        up = "(SELECT budget FROM root) AS b" if above is None else "u.budget AS b"
        link = "" if above is None else f" JOIN {above} u ON " + " AND ".join(f"u.{k} IS NOT DISTINCT FROM n.{k}" for k in path[:-1])
        order = f"({parent} ORDER BY capacity::DOUBLE / weight::DOUBLE, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        steps.append(f"""
n{depth} AS (SELECT n.*, {up} FROM ({nodes}) n{link}),
p{depth} AS (SELECT *, b - coalesce(sum(capacity) OVER {order}, 0) AS rest, sum(weight) OVER ({parent}) - coalesce(sum(weight) OVER {order}, 0) AS lft,
                row_number() OVER ({parent} ORDER BY capacity::DOUBLE / weight::DOUBLE, {name}) AS k FROM n{depth}),
f{depth} AS (SELECT *, min(CASE WHEN rest * weight < capacity * lft THEN k END) OVER ({parent}) AS kk FROM p{depth}),
g{depth} AS (SELECT *, max(CASE WHEN k = kk THEN rest END) OVER ({parent}) AS r, max(CASE WHEN k = kk THEN lft END) OVER ({parent}) AS l FROM f{depth}),
a{depth} AS (SELECT {", ".join(path)}, CASE WHEN kk IS NULL OR k < kk THEN capacity ELSE r::HUGEINT * weight // l::HUGEINT END AS budget FROM g{depth})""")
        above = f"a{depth}"
    return f"""
WITH sized AS (
  SELECT doc_id, lang, source, {domain} AS domain, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS n FROM documents),
docs AS (SELECT * FROM sized WHERE n > 0),
leaves AS (SELECT domain, lang, source, sum(n) AS tokens FROM docs GROUP BY domain, lang, source),
root AS (SELECT least(sum(tokens)::HUGEINT * {SHARE_PERCENT} // 100, sum(tokens)::HUGEINT * {MAX_EPOCHS}) AS budget FROM leaves),{",".join(steps)},
plan AS (SELECT l.*, a.budget // l.tokens::HUGEINT AS whole, a.budget % l.tokens::HUGEINT AS rest
         FROM leaves l JOIN {above} a ON a.domain = l.domain AND a.lang IS NOT DISTINCT FROM l.lang AND a.source IS NOT DISTINCT FROM l.source),
keyed AS (SELECT d.*, p.whole, p.rest, md5('{SEED}:' || p.whole::VARCHAR || ':' || d.doc_id::VARCHAR) AS key
          FROM docs d JOIN plan p ON p.domain = d.domain AND p.lang IS NOT DISTINCT FROM d.lang AND p.source IS NOT DISTINCT FROM d.source),
placed AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM keyed),
taken AS (
  SELECT doc_id, domain, lang, source, unnest(range(0, whole::BIGINT)) AS epoch, n, n AS take FROM keyed
  UNION ALL SELECT doc_id, domain, lang, source, whole::BIGINT, n, least(n, rest - ahead) FROM placed WHERE ahead < rest)
SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, n::BIGINT AS n_tokens, take::BIGINT AS take_tokens FROM taken"""


ANSI = _ansi()
