"""Mixing documents to target shares by iterative proportional fitting.

Token counts of the cells source x language x topic are raked: in turn, the cells of every source,
language and topic are scaled to that value's target share, until all three marginals hold. The
sample's size is set beforehand and a cell's weight is its documents' probability: no weight passes
1, and what a full cell or value cannot give the others do. DataFrame work only.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.llm.stages import Stages

WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS = ("source", "lang", "topic")
#: Value of a missing source, language or topic; present values carry a leading "=".
MISSING = "?"


def form_topic(text: str = "text") -> Column:
    """A coarse topic from the form of a text, for tables without a topic column."""
    column = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(column.contains("|"), "table").when(column.contains("!!"), "shouting")
        .when(F.regexp_count(column, F.lit("[0-9]")) > 0, "figures")
        .when(F.length(column) < 1000, "note").when(F.length(column) < 5000, "article")
        .otherwise("book")
    )


@dataclass(frozen=True)
class Settings:
    """``targets`` maps a dimension to shares of its values; values it leaves out get nothing.

    A dimension without targets is tempered: shares in proportion to the present ones raised to
    ``temper``, which lifts small values and lowers dominant ones.

    ``keep`` is the share of all tokens that the sample holds in expectation, whatever the cells
    are. A value whose target is more than it has is kept whole, and the others share the rest.
    Without ``keep`` the shares hold exactly, so the cell of the largest weight sets the size: one
    rare cell can lower it to next to nothing.
    """

    targets: dict[str, dict[str | None, float]] = field(default_factory=dict)
    temper: float = 0.7
    keep: float | None = 0.3
    tolerance: float = 1e-9
    sweeps: int = 40
    seed: str = "mix"


def _value(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(MISSING))


def _prepared(docs: DataFrame, topic: Column) -> DataFrame:
    return docs.withColumns(
        {
            "__tokens": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "__source": _value(F.col("source")), "__lang": _value(F.col("lang")), "__topic": _value(topic),
        }
    )


def _targets(cells: DataFrame, settings: Settings) -> DataFrame:
    """``dimension, value, mass``: the tokens that each marginal should hold, adding up to all tokens, or
    to the share ``keep`` of them with no value above what it has.
    """
    present = reduce(
        DataFrame.unionByName,
        (
            cells.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").cast("double").alias("tokens"))
            .withColumn("dimension", F.lit(name))
            for name in DIMENSIONS
        ),
    )
    given = [
        (name, MISSING if key is None else f"={key}", float(share))
        for name, shares in settings.targets.items() for key, share in shares.items()
    ]
    tempered = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(settings.temper))).otherwise(0.0)
    if given:
        table = cells.sparkSession.createDataFrame(given, "dimension string, value string, given double")
        named = F.col("dimension").isin(*settings.targets)
        present = present.join(table, ["dimension", "value"], "left").withColumn(
            "share", F.when(named, F.coalesce("given", F.lit(0.0))).otherwise(tempered)
        )
    else:
        present = present.withColumn("share", tempered)
    whole = Window.partitionBy("dimension")
    present = present.withColumns(
        {"all_tokens": F.sum("tokens").over(whole), "all_share": F.sum("share").over(whole)}
    )
    share, tokens = F.col("share"), F.col("tokens")
    if settings.keep is None:
        mass = F.when(F.col("all_share") > 0, share / F.col("all_share") * F.col("all_tokens")).otherwise(0.0)
        return present.select("dimension", "value", mass.alias("mass"))
    # Values in the order in which a growing scale fills them; the scale is that of the first value
    # which it does not fill when all before it are full.
    ratio = F.when(share > 0, tokens / share)
    order = Window.partitionBy("dimension").orderBy(ratio, "value")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda column: F.coalesce(F.sum(F.when(share > 0, column)).over(earlier), F.lit(0.0))
    wanted = F.lit(settings.keep) * F.col("all_tokens")
    scale = (wanted - sum_before(tokens)) / (F.col("all_share") - sum_before(share))
    present = present.withColumn("scale", F.when(share > 0, scale))
    unfilled = F.when(F.col("scale") * share <= tokens, F.struct(ratio.alias("ratio"), "value", "scale"))
    return present.withColumn("scale", F.min(unfilled).over(whole)["scale"]).select(
        "dimension", "value",
        F.when(share > 0, F.least(tokens, F.coalesce(share * F.col("scale"), tokens))).otherwise(0.0).alias("mass"),
    )


def _factor(settings: Settings) -> Column:
    """What a value's cells are scaled by, from its ``mass`` and its ``held`` and ``full`` tokens."""
    if settings.keep is None:
        return F.when(F.col("held") > 0, F.col("mass") / F.col("held")).otherwise(0.0)
    free = F.col("held") - F.col("full")
    return (
        F.when(F.col("held") <= 0, 0.0)
        .when((F.col("mass") < F.col("held")) | (free <= 0), F.least(F.lit(1.0), F.col("mass") / F.col("held")))
        .otherwise((F.col("mass") - F.col("full")) / free)
    )


#: Sweeps between two written tables, after which convergence is looked at.
WRITTEN_SWEEPS = 4


def _swept(cells: DataFrame, settings: Settings) -> DataFrame:
    """Fit each dimension once; ``before`` keeps the weight that the sweep began with."""
    amount, weight = F.col("tokens") * F.col("weight"), F.col("weight")
    cells = cells.withColumn("before", weight)
    for name in DIMENSIONS:
        value = Window.partitionBy(name)
        scaled = weight * _factor(settings)
        cells = cells.withColumns(
            {
                "mass": F.col(f"mass_{name}"), "held": F.sum(amount).over(value),
                "full": F.sum(F.when(weight >= 1, amount).otherwise(0.0)).over(value),
            }
        ).withColumn("weight", scaled if settings.keep is None else F.least(F.lit(1.0), scaled))
    return cells.drop("mass", "held", "full")


def rake(cells: DataFrame, settings: Settings, stages: Stages) -> DataFrame:
    """``source, lang, topic, tokens, weight`` and each dimension's ``mass_``: cells raked to the targets.

    A sweep fits each dimension once, by sums over the cells of each value; a few sweeps' cells are
    written at a time. With ``keep`` no weight passes 1: scaling to a marginal and cutting at 1 are
    projections in turn, which end where all of them hold. Marginals that contradict each other,
    or ask for values without tokens, end after ``sweeps`` sweeps, or where a sweep changes
    nothing. ``marginals`` tells how far each is off; a warning says if one is by over a hundredth.
    """
    start = 1.0 if settings.keep is None else float(settings.keep)
    current = cells.withColumn("weight", F.lit(start))
    targets = stages.write(_targets(cells, settings))
    for name in DIMENSIONS:
        own = targets.where(F.col("dimension") == name)
        current = current.join(own.select(F.col("value").alias(name), F.col("mass").alias(f"mass_{name}")), name)
    written = stages.write(current)
    moved, done = None, 0
    while done < settings.sweeps:
        for _ in range(min(WRITTEN_SWEEPS, settings.sweeps - done)):
            current = _swept(current, settings)
            done += 1
        last, written = written, stages.write(current)
        stages.drop(last)
        moving = (F.col("tokens") > 0) & (F.col("before") > 0)
        change = F.abs(F.col("weight") - F.col("before")) / F.col("before")
        moved = written.agg(F.max(F.when(moving, change))).first()[0]
        current = written.drop("before")
        if moved is None or moved <= settings.tolerance:
            break
    worst = residuals(current).agg(F.max(F.abs(F.col("residual")))).first()[0] or 0.0
    if worst > OFF:
        warnings.warn(f"a marginal is off by {worst:.3g} of its target after {done} sweeps; see marginals()", stacklevel=2)
    return current


#: Share of its target by which a marginal may be off without a warning.
OFF = 0.01


def residuals(raked: DataFrame) -> DataFrame:
    """``dimension, value, target, held, residual`` of every marginal of raked cells, in tokens."""
    parts = [
        raked.groupBy(F.col(name).alias("value")).agg(
            F.max(f"mass_{name}").alias("target"), F.sum(F.col("tokens") * F.col("weight")).alias("held")
        ).select(
            F.lit(name).alias("dimension"), F.when(F.col("value") != MISSING, F.substring("value", 2, 1 << 30)).alias("value"),
            "target", "held",
            F.when(F.col("target") > 0, (F.col("held") - F.col("target")) / F.col("target")).alias("residual"),
        )
        for name in DIMENSIONS
    ]
    return reduce(DataFrame.unionByName, parts)


def marginals(docs: DataFrame, topic: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """``dimension, value, target, held, residual``: what each marginal should hold and does, in tokens.

    ``residual`` is the difference as a share of the target, null for a target of nothing.
    """
    stages = Stages(docs.sparkSession, "mixing")
    return residuals(rake(_cells(_prepared(docs, _topic(docs, topic)), stages), settings, stages))


def _topic(docs: DataFrame, topic: Column | None) -> Column:
    """The given topic, else the table's own column, else one from the form of the text."""
    if topic is not None:
        return topic
    return F.col("topic") if "topic" in docs.columns else form_topic()


def _cells(prepared: DataFrame, stages: Stages) -> DataFrame:
    return stages.write(
        prepared.groupBy(*(F.col(f"__{d}").alias(d) for d in DIMENSIONS)).agg(F.sum("__tokens").alias("tokens"))
    )


def probabilities(docs: DataFrame, topic: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """All rows and columns of ``docs`` with ``tokens``, ``topic``, ``probability``, ``sampled``.

    Tokens are words. The probability is the cell's weight, raked so that the kept tokens come to
    ``settings.keep`` of all and hold the target shares in expectation, as far as the tokens
    reach. Without ``keep`` it is the weight over the largest weight of any cell with tokens. No
    probability exceeds 1. A document without tokens follows its cell; a cell without tokens has
    probability 0. The draw hashes ``doc_id``: repeated rows go or stay together, also from run
    to run. Null sources, languages and topics are values of their own. Columns named ``tokens``,
    ``probability`` or ``sampled`` are replaced; a ``topic`` column stays and is the topic, unless
    another one is given.
    """
    stages = Stages(docs.sparkSession, "mixing")
    results = ("tokens", "probability", "sampled", "topic")
    own = [c for c in docs.columns if c not in results]
    own_topic = topic is None and "topic" in docs.columns
    prepared = _prepared(docs, _topic(docs, topic))
    raked = rake(_cells(prepared, stages), settings, stages)
    largest = 1.0
    if settings.keep is None:
        largest = raked.where(F.col("tokens") > 0).agg(F.max("weight")).first()[0] or 0.0
    share = F.when(F.col("tokens") > 0, F.col("weight") / F.lit(largest)) if largest else F.lit(0.0)
    weights = stages.write(
        raked.select(
            *(F.col(d).alias(f"__{d}") for d in DIMENSIONS), F.coalesce(share, F.lit(0.0)).alias("probability")
        )
    )
    digits = F.substring(F.md5(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13)
    draw = F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))
    shown = F.col("topic") if own_topic else F.when(F.col("__topic") != MISSING, F.substring("__topic", 2, 1 << 30))
    return prepared.select(
        *own, *(["topic"] if own_topic else []), "__tokens", *(f"__{d}" for d in DIMENSIONS)
    ).join(weights, [f"__{d}" for d in DIMENSIONS]).select(
        *own, F.col("__tokens").alias("tokens"), shown.alias("topic"),
        "probability", (draw < F.col("probability")).alias("sampled"),
    )


def oracle(settings: Settings = Settings(), sweeps: int = 25) -> str:
    """DuckDB SQL over ``documents``, with the sweeps written out and tempered targets."""
    parts = [
        """docs AS MATERIALIZED (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens,
         coalesce('=' || source, '?') AS source, coalesce('=' || lang, '?') AS lang,
         '=' || CASE WHEN contains(coalesce(text, ''), '|') THEN 'table'
           WHEN contains(coalesce(text, ''), '!!') THEN 'shouting'
           WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures'
           WHEN length(coalesce(text, '')) < 1000 THEN 'note'
           WHEN length(coalesce(text, '')) < 5000 THEN 'article' ELSE 'book' END AS topic
  FROM documents)""",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, 1.0::DOUBLE AS w "
        "FROM docs GROUP BY ALL)",
    ]
    for name in DIMENSIONS:
        parts.append(
            f"t_{name} AS MATERIALIZED (SELECT {name}, share / sum(share) OVER () * sum(tokens) OVER () AS mass "
            f"FROM (SELECT {name}, sum(tokens) AS tokens, CASE WHEN sum(tokens) > 0 "
            f"THEN pow(sum(tokens), {settings.temper}) ELSE 0 END AS share FROM c0 GROUP BY {name}))"
        )
    n = 0
    for _ in range(sweeps):
        for name in DIMENSIONS:
            parts.append(
                f"c{n + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, "
                f"c.w * CASE WHEN h.held > 0 THEN t.mass / h.held ELSE 0 END AS w FROM c{n} c "
                f"JOIN (SELECT {name}, sum(tokens * w) AS held FROM c{n} GROUP BY {name}) h USING ({name}) "
                f"JOIN t_{name} t USING ({name}))"
            )
            n += 1
    return "WITH " + ",\n".join(parts) + f""",
p AS (SELECT source, lang, topic, CASE WHEN tokens > 0
        THEN w / (SELECT max(w) FROM c{n} WHERE tokens > 0) ELSE 0 END AS p FROM c{n})
SELECT doc_id, tokens, substr(topic, 2) AS topic, round(p, 6) AS probability,
       ('0x' || substr(md5('{settings.seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
         / {float(16**13)!r} < p AS sampled
FROM docs JOIN p USING (source, lang, topic)
"""
