"""Mixing sources to target weights, in DataFrame functions only.

Documents are counted into cells of (source, language, topic). Iterative proportional fitting rakes the tokens that a
sample takes from the cells, one margin after another, until each margin has its target share; the cells keep the
interactions that the data have. No cell can give more than it has, and that bound is part of the raking: a full cell
stays full, and the other cells of its margin make up for it. A document is then kept with the probability that turns its
cell's tokens into the cell's share of the sample. The draw is a hash of the key, so it is the same in every run and
every retry.

Only the cells, a table with a row for each combination of values, go through the rounds; each round is written. Rounds
end when nothing moves any more. Targets that the data cannot meet at the asked size are missed by as little as the
rounds can; `margins` reports every target with what is reached and what there is.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import replacing, settle

MARGINS = ("source", "lang", "topic")
#: Passes over the three margins at most; they end when no cell's share of the sample changes by more than the tolerance.
ROUNDS, TOLERANCE = 20, 1e-7
#: The share of all tokens that a sample has.
FRACTION = 0.7
#: Topics by what marks them, in the order in which ties are settled; a text with none of the marks is "prose".
TOPICS = {"listing": r" \| ", "contact": "@", "markup": r"[&%#$*]{3}", "rights": r"[Ll]icen[cs]e|[Rr]ights reserved"}
#: Targets are shares to this power, made to add up to one: below 1 it lifts small sources.
TEMPERATURES = {"source": 0.7, "lang": 0.8, "topic": 0.9}
#: Bits of the draw.
DRAW_BITS = 32
#: Cells in a partition. Up to that many go through several rounds in one task; more are shuffled by margin in each.
CELL_ROWS, ROUNDS_AT_ONCE = 100_000, 5
#: A miss of a target share that is worth a warning.
MISS = 1e-3


def topic(text: Column, topics: dict[str, str] = TOPICS, other: str = "prose") -> Column:
    """The topic whose pattern occurs most often in the text, of equally frequent ones the first named; `other` if none occurs."""
    counts = [F.regexp_count(text, F.lit(p)) for p in topics.values()]
    most = F.greatest(*counts, F.lit(0))
    out = F.when(most == 0, other)
    for name, n in zip(topics, counts, strict=True):
        out = out.when(n == most, name)
    return out


def tokens(text: Column) -> Column:
    """Tokens, estimated as one for every four bytes of UTF-8."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Targets (margin, share) that are the margin's token shares to a power."""
    sums = cells.groupBy(margin).agg(F.sum("n").alias("n")).where("n > 0")
    raised = F.pow(F.col("n").cast("double"), F.lit(power))
    total = sums.agg(F.sum(raised)).first()[0] or 1.0
    return sums.select(margin, (raised / total).alias("share"))


def _gathered(df: DataFrame, cells: int) -> DataFrame:
    """A frame derived from so many cells, in no more partitions than they fill."""
    return df.coalesce(1 + cells // CELL_ROWS)


def _aims(cells: DataFrame, margin: str, target: DataFrame, count: int) -> DataFrame:
    """(value, tokens there are, share) of every value of a margin; shares add up to one over the values with tokens."""
    have = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("n").alias("available"))
    given = target.select(F.col(margin).alias("_v"), F.col("share").cast("double").alias("share"))
    joined = have.join(given, F.col("value").eqNullSafe(F.col("_v")), "left")
    share = F.when(F.col("available") > 0, F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(0.0))).otherwise(0.0)
    aims = settle(_gathered(joined.select("value", F.coalesce("available", F.lit(0)).alias("available"), share.alias("share")), count))
    total = aims.agg(F.sum("share")).first()[0] or 1.0
    return aims.withColumn("share", F.col("share") / total)


def _fitted(cells: DataFrame, margin: str, asked: float, together: bool) -> DataFrame:
    """The cells with `w` moved so that the tokens taken from each value, at most n of a cell, come to its budget.

    One step: what the full cells hold is set off, and the open ones are scaled to the rest. Where the full cells alone
    hold more than the budget, all are scaled down. Cells that are `together` in one partition need no shuffle.
    """
    full = F.col("w") >= F.col("n")
    sums = {
        "_filled": F.sum(F.when(full, F.col("n")).otherwise(0.0)),
        "_open": F.sum(F.when(full, 0.0).otherwise(F.col("w"))),
        "_all": F.sum(F.least("w", "n")),
    }
    if together:
        own = Window.partitionBy(margin)
        joined = cells.select("*", *[c.over(own).alias(name) for name, c in sums.items()])
    else:
        found = cells.groupBy(F.col(margin).alias("_m")).agg(*[c.alias(name) for name, c in sums.items()])
        joined = cells.join(found, F.col(margin).eqNullSafe(F.col("_m"))).drop("_m")
    budget = F.col(f"_share_{margin}") * asked
    moved = (
        F.when(F.col("_filled") > budget, F.least("w", "n") * (budget / F.col("_all")))
        .when(F.col("_open") > 0, F.col("w") * ((budget - F.col("_filled")) / F.col("_open")))
        .otherwise(F.col("w"))
    )
    return joined.withColumn("w", F.least(moved, F.lit(1e150))).drop(*sums)


def _raked(cells: DataFrame, margins: list[str], asked: float, rounds: int, together: bool) -> DataFrame:
    """So many rounds over all margins; `_change` is the largest move of a cell's tokens in the last round that moved any
    by more than the tolerance or was the first not to. Rounds after that one leave all as it is."""
    for _ in range(rounds):
        done = F.col("_change") <= TOLERANCE * asked
        cells = cells.withColumn("_was", F.col("w"))
        for margin in margins:
            cells = _fitted(cells, margin, asked, together)
        step = F.abs(F.least("w", "n") - F.least("_was", "n"))
        change = F.max(step).over(Window.partitionBy(F.lit(0))) if together else step
        cells = cells.withColumns({"w": F.when(done, F.col("_was")).otherwise(F.col("w")), "_change": F.when(done, F.col("_change")).otherwise(change)})
        cells = cells.drop("_was")
    return cells


def fitted(cells: DataFrame, targets: dict[str, DataFrame], fraction: float = FRACTION, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The cells (margins, `n` tokens) with the probability `p` of a token, and the margins that are reached.

    `targets` has for each margin a DataFrame (margin, `share`). Values that it does not name get nothing; nulls are a value
    like any other. The margins are (margin, value, target, reached, available), in shares of the sample asked for;
    available is what the value has in all.
    """
    total, count = cells.agg(F.sum("n"), F.count("*")).first()
    aims = {m: _aims(cells, m, t, count) for m, t in targets.items()}
    asked, together, margins_ = float(total or 0) * fraction, count <= CELL_ROWS, list(targets)
    out = cells.select(*targets, F.coalesce("n", F.lit(0)).cast("double").alias("n")).withColumn("w", F.col("n"))
    for m, aim in aims.items():
        shares = aim.select(F.col("value").alias("_v"), F.col("share").alias(f"_share_{m}"))
        out = out.join(shares, F.col(m).eqNullSafe(F.col("_v"))).drop("_v")
    out = settle(_gathered(out.withColumn("_change", F.lit(1e300)), count))
    at_once = ROUNDS_AT_ONCE if together else 1
    for begun in range(0, rounds if asked else 0, at_once):
        rows = out.coalesce(1) if together else out.withColumn("_change", F.lit(1e300))
        out = settle(_gathered(_raked(rows, margins_, asked, min(at_once, rounds - begun), together), count))
        if out.agg(F.max("_change")).first()[0] <= TOLERANCE * asked:
            break
    taken = F.least("w", "n")
    out = out.select(*targets, F.col("n").cast("long").alias("n"), F.when(F.col("n") > 0, taken / F.col("n")).otherwise(0.0).alias("p"))
    out = settle(out)
    reached = []
    for margin, aim in aims.items():
        have = out.groupBy(F.col(margin).alias("_m")).agg((F.sum(F.col("n") * F.col("p")) / (asked or 1.0)).alias("reached"))
        joined = aim.join(have, F.col("value").eqNullSafe(F.col("_m")))
        columns = F.col("share").alias("target"), "reached", (F.col("available") / (asked or 1.0)).alias("available")
        reached.append(joined.select(F.lit(margin).alias("margin"), F.col("value").cast("string").alias("value"), *columns))
    return out, reduce(DataFrame.unionByName, reached)


def draw(key: Column, text: Column) -> Column:
    """A number from 0 to below 1 that depends on the key alone, or on the text where the key is null."""
    digest = F.md5(F.coalesce(key.cast("string"), text).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("double") / float(1 << DRAW_BITS)


def _rows(docs: DataFrame, text: str, key: str, source: str, lang: str) -> DataFrame:
    names = {"source": source, "lang": lang}
    body = F.coalesce(F.col("row").getField(text), F.lit(""))
    return docs.select(F.struct("*").alias("row")).select(
        "row",
        *[F.col("row").getField(c).cast("string").alias(m) for m, c in names.items()],
        topic(body).alias("topic"),
        tokens(body).alias("tokens"),
        draw(F.col("row").getField(key), body).alias("u"),
    )


def _aimed(
    rows: DataFrame, targets: dict[str, DataFrame] | None, temperatures: dict[str, float] | None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The cells of the rows, and the targets by margin."""
    cells = settle(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("n")))
    cells = settle(_gathered(cells, cells.count()))
    powers, given = TEMPERATURES | (temperatures or {}), targets or {}
    return cells, {m: settle(given[m] if m in given else tempered(cells, m, powers[m])) for m in MARGINS}


def weighed(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    targets: dict[str, DataFrame] | None = None,
    fraction: float = FRACTION,
    temperatures: dict[str, float] | None = None,
) -> DataFrame:
    """All rows as a struct `row` with `topic`, `tokens`, the probability `p`, the weight `w` of a token, and `kept`.

    `targets` has, for "source", "lang" and "topic", a DataFrame (that column, `share`); without them the tempered shares
    of the data are the targets. Null sources and languages are values like any other; documents without tokens
    follow their cell's probability, which is 0 if the cell has none. Rows that share a key share their draw; repeated rows
    stay or go together. Texts of any length are read whole, null texts as empty.
    """
    rows = _rows(docs, text, key, source, lang)
    cells, aims = _aimed(rows, targets, temperatures)
    shares, reached = fitted(cells, aims, fraction)
    worst = reached.agg(F.max(F.abs(F.col("target") - F.col("reached")))).first()[0] or 0.0
    if worst > MISS:
        logging.getLogger(__name__).warning("targets cannot all be met at this size: the worst share is off by %.4f", worst)
    shares = shares.select(*[F.col(m).alias("_" + m) for m in MARGINS], "p")
    same = [F.col(m).eqNullSafe(F.col("_" + m)) for m in MARGINS]
    joined = rows.join(shares, same[0] & same[1] & same[2])
    return joined.select("row", "topic", "tokens", "p", (F.col("p") / fraction).alias("w"), (F.col("u") < F.col("p")).alias("kept"))


def margins(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    targets: dict[str, DataFrame] | None = None,
    fraction: float = FRACTION,
    temperatures: dict[str, float] | None = None,
) -> DataFrame:
    """What a sample is expected to reach: (margin, value, target, reached, available); see `fitted`."""
    return fitted(*_aimed(_rows(docs, text, text, source, lang), targets, temperatures), fraction)[1]


def mark(docs: DataFrame, **options) -> DataFrame:
    """Every row with `topic`, `tokens`, `probability`, `weight` and `kept`; options as of `weighed`."""
    return weighed(docs, **options).select(
        *replacing(
            "row",
            docs.columns,
            topic=F.col("topic"),
            tokens=F.col("tokens"),
            probability=F.col("p"),
            weight=F.col("w"),
            kept=F.col("kept"),
        )
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with the input's columns; options as of `weighed`."""
    return weighed(docs, **options).where("kept").select(*replacing("row", docs.columns))


def sample_sql(source: str = "documents") -> str:
    """DuckDB's SQL for `mark` over a table, with the defaults: (doc_id, topic, tokens, probability, weight, kept)."""
    patterns = list(TOPICS.items())
    counts = ", ".join(f"len(regexp_extract_all(t, '{p}')) AS c{i}" for i, (_, p) in enumerate(patterns))
    most = "greatest(" + ", ".join(f"c{i}" for i in range(len(patterns))) + ")"
    cases = " ".join(f"WHEN c{i} = {most} THEN '{name}'" for i, (name, _) in enumerate(patterns))
    parts = [
        f"""t0 AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM {source}),
t1 AS (SELECT *, CAST(ceil(strlen(t) / 4) AS BIGINT) AS tokens, {counts},
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), t)), 1, 8) AS BIGINT) / {1 << DRAW_BITS}.0 AS u FROM t0),
t2 AS (SELECT *, CASE WHEN {most} = 0 THEN 'prose' {cases} END AS topic FROM t1),
cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS n FROM t2 GROUP BY ALL)"""
    ]
    for m in MARGINS:
        parts.append(
            f"aim_{m} AS (SELECT {m}, pow(n, {TEMPERATURES[m]}) / sum(pow(n, {TEMPERATURES[m]})) OVER () AS share "
            f"FROM (SELECT {m}, sum(n) AS n FROM cells GROUP BY 1) WHERE n > 0)"
        )
    last = "w0"
    parts.append(f"w0 AS MATERIALIZED (SELECT *, n AS w, 1e300 AS change, {FRACTION} * sum(n) OVER () AS asked FROM cells)")
    for i in range(1, ROUNDS + 1):
        before = last
        for m in MARGINS:
            now = f"w{i}_{m}"
            parts.append(
                f"{now} AS MATERIALIZED (SELECT * EXCLUDE (w, filled, open, taken, b), CASE WHEN filled > b THEN least(w, n) * (b / taken) "
                f"WHEN open > 0 THEN w * ((b - filled) / open) ELSE w END AS w FROM (SELECT c.*, coalesce(share, 0.0) * asked AS b, "
                f"sum(CASE WHEN w >= n THEN n ELSE 0 END) OVER v AS filled, sum(CASE WHEN w >= n THEN 0 ELSE w END) OVER v AS open, "
                f"sum(least(w, n)) OVER v AS taken FROM {last} c LEFT JOIN aim_{m} a ON a.{m} IS NOT DISTINCT FROM c.{m} "
                f"WINDOW v AS (PARTITION BY c.{m})))"
            )
            last = now
        same = " AND ".join(f"x.{m} IS NOT DISTINCT FROM y.{m}" for m in MARGINS)
        # rounds after the one in which nothing moves any more change nothing
        parts.append(
            f"w{i} AS MATERIALIZED (SELECT x.* EXCLUDE (w, change), CASE WHEN x.change <= {TOLERANCE} * x.asked THEN x.w ELSE y.w END AS w, "
            f"CASE WHEN x.change <= {TOLERANCE} * x.asked THEN x.change ELSE max(abs(least(x.w, x.n) - least(y.w, y.n))) OVER () END AS change "
            f"FROM {before} x JOIN {last} y ON {same})"
        )
        last = f"w{i}"
    parts.append(f"shares AS (SELECT *, CASE WHEN n > 0 THEN least(w, n) / n ELSE 0 END AS p FROM {last})")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT doc_id, t2.topic, tokens, round(p, 6) AS probability, round(p / {FRACTION}, 6) AS weight, u < p AS kept
FROM t2 JOIN shares c ON t2.topic = c.topic AND t2.source IS NOT DISTINCT FROM c.source AND t2.lang IS NOT DISTINCT FROM c.lang"""
    )
