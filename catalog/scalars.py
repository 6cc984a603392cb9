"""String functions over whole texts."""

from pyspark.sql import functions as F

from tidespan.functions import strings as S

from .base import query


def sql(exprs):
    return f"SELECT doc_id, {exprs} FROM documents"


@query(
    "string_predicates",
    sql("contains(text, 'the') AS has, lang = 'fr' AS french, regexp_matches(text, '[0-9]{3}') AS digits, lower(lang) = 'en' AS english"),
)
def string_predicates(t):
    return t.read("documents").select(
        "doc_id",
        S.contains("text", "the").alias("has"),
        S.equals("lang", "fr").alias("french"),
        S.is_match("text", "[0-9]{3}").alias("digits"),
        S.equals("lang", "EN", ignore_case=True).alias("english"),
    )


@query(
    "string_index",
    sql(
        """CAST(instr(text, 'on') - 1 AS INTEGER) AS first,
CASE WHEN instr(substr(text, 11), 'on') > 0 THEN CAST(instr(substr(text, 11), 'on') + 9 AS INTEGER) ELSE -1 END AS later,
CASE WHEN instr(substr(text, 11, 20), 'on') > 0 THEN CAST(instr(substr(text, 11, 20), 'on') + 9 AS INTEGER) ELSE -1 END AS within,
CAST(instr(lower(text), 'th') - 1 AS INTEGER) AS any_case"""
    ),
)
def string_index(t):
    """0-based positions, -1 when absent."""
    return t.read("documents").select(
        "doc_id",
        S.index_of("text", "on").alias("first"),
        S.index_of("text", "on", 10).alias("later"),
        S.index_of("text", "on", 10, 20).alias("within"),
        S.index_of("text", "TH", ignore_case=True).alias("any_case"),
    )


# Where the 20 characters that end at position 30, or at the end of a shorter text, begin.
BACK = "greatest(0, least(length(text), 31) - 20)"


def last(piece, part, base="0"):
    n = len(part)
    back = f"instr(reverse({piece}), '{part[::-1]}')"
    return f"CASE WHEN {back} > 0 THEN CAST({base} + length({piece}) - {back} - {n - 1} AS INTEGER) ELSE -1 END"


@query(
    "string_last_index",
    sql(
        f"{last('text', 'on')} AS last, {last('substr(text, 1, 31)', 'on')} AS before, "
        f"{last(f'substr(text, {BACK} + 1, 20)', 'on', BACK)} AS within"
    ),
)
def string_last_index(t):
    return t.read("documents").select(
        "doc_id",
        S.last_index_of("text", "on").alias("last"),
        S.last_index_of("text", "on", 30).alias("before"),
        S.last_index_of("text", "on", 30, 20).alias("within"),
    )


@query(
    "string_transforms",
    sql("md5(lower(lang)) AS low, upper(lang) AS up, substr(text, 6, 10) AS part, substr(text, 4) AS rest, CAST(length(text) AS INTEGER) AS n"),
)
def string_transforms(t):
    return t.read("documents").select(
        "doc_id",
        F.md5(S.lower("lang")).alias("low"),
        S.upper("lang").alias("up"),
        S.substring("text", 5, 10).alias("part"),
        S.substring("text", 3).alias("rest"),
        S.length("text").alias("n"),
    )


@query("string_split", "SELECT doc_id, unnest(regexp_split_to_array(text, '[.,;]')) AS piece FROM documents")
def string_split(t):
    """Every piece of every text."""
    return t.read("documents").select("doc_id", F.explode(S.split("text", "[.,;]")).alias("piece"))


@query("string_split_chars", sql("len(regexp_split_to_array(text, '[ .]')) AS pieces"))
def string_split_chars(t):
    n = F.size(S.split_chars("text", " .")).cast("bigint")
    return t.read("documents").select("doc_id", n.alias("pieces"))


@query("row_hash", "SELECT doc_id, true AS equal FROM documents")
def row_hash(t):
    """Equal values have equal hashes; the hash values themselves are Spark's."""
    df = t.read("documents").select("doc_id", S.row_hash("text", "lang").alias("h"))
    other = t.read("documents").select("doc_id", S.row_hash("text", "lang").alias("h2"))
    return df.join(other, "doc_id").select("doc_id", (F.col("h") == F.col("h2")).alias("equal"))


@query(
    "expressions",
    """SELECT event_id, CAST(floor(sqrt(value * 100)) AS BIGINT) AS root, year(ts) * 100 + month(ts) AS ym,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, [event_id % 3, event_id % 5][2] AS pick FROM events""",
)
def expressions(t):
    """Any native expression: math, dates, JSON, arrays."""
    return t.read("events").select(
        "event_id",
        F.floor(F.sqrt(F.col("value") * 100)).alias("root"),
        (F.year("ts") * 100 + F.month("ts")).cast("bigint").alias("ym"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.element_at(F.array(F.col("event_id") % 3, F.col("event_id") % 5), 2).alias("pick"),
    )


@query(
    "custom_equality",
    """SELECT lower(source) AS source_key, count(*) AS n FROM documents GROUP BY ALL""",
)
def custom_equality(t):
    """Key equality other than the default, as a canonical key expression."""
    return t.read("documents").groupBy(F.lower("source").alias("source_key")).agg(F.count("*").alias("n"))
