"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Fixed patterns give seed entities. The cue in front of an entity ("phone:", "ssn=") is its
lexical pattern. Patterns and the identifiers behind them form a graph: a pattern is as
sure as its instances are on average, an instance as sure as its patterns make it
together. After a few rounds, sure patterns mark identifiers that no fixed pattern knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach, documents_of
from gaugeworks.session import written

KINDS = ("email", "ip", "card", "phone")
#: Stand-ins of one code point: a separator between digits, a dot inside a domain, and
#: what takes the place of these two in the text itself.
_GLUE, _DOT, _NEITHER = "", "", ""
_SPAN = "array<struct<s:int,e:int,v:string>>"

# Runs are possessive and start only where a run does (or where the last match ended), so
# long runs cost no backtracking; glued separators make one run of what would be a group.
_EMAIL = (
    rf"(?:\G|(?<![A-Za-z0-9._%+\-{_DOT}]))[A-Za-z0-9._%+\-{_DOT}]++@"
    rf"[A-Za-z0-9-]++{_DOT}[A-Za-z0-9\-{_DOT}]++"
)
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"[0-9][0-9{_GLUE}]++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IP_PARTS = r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(\.|$)){4}$"
#: A cue word with its sign, up to two spaces, and a token.
_CUED = r"(?<![A-Za-z])[A-Za-z]{2,20}[:=#]\x20{0,2}[A-Za-z0-9][A-Za-z0-9./_-]{4,40}"
_CUE = r"^[A-Za-z]{2,20}[:=#]\x20{0,2}"


def _matches(text: Column, pattern: str) -> Column:
    """Spans (s, e, v) of all matches: the pieces between them give the places."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(
        values,
        F.slice(gaps, F.lit(1), F.size(values)),
        lambda v, gap: F.struct(F.char_length(gap).alias("gap"), v.alias("v")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(done: Column, x: Column) -> Column:
        s = done["at"] + x["gap"]
        e = s + F.char_length(x["v"])
        one = F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v"))
        return F.struct(e.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    return F.aggregate(steps, start, step, lambda done: done["out"])


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))
    n = F.char_length(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), n),
        lambda k: F.substring(digits, k, F.lit(1)).cast("int") * (F.lit(2) - k % 2),
    )
    total = F.aggregate(doubled, F.lit(0), lambda t, d: t + F.when(d > 9, d - 9).otherwise(d))
    return F.when(n.between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def _where(has: Column, text: str) -> Column:
    return F.when(has, F.col(text)).otherwise(F.lit(""))


def base_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and one array of spans per kind, as the fixed patterns find them."""
    own = documents_of(docs, id_col, text_col)
    neutral = F.translate("text", _GLUE + _DOT, _NEITHER * 2)
    glued = F.regexp_replace("neutral", r"(?<=[0-9])[\x20-](?=[0-9])", _GLUE)
    dotted = F.regexp_replace("neutral", r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT)
    has_digits = F.col("neutral").rlike("[0-9]")
    own = own.withColumn("neutral", neutral).select(
        "doc_id",
        "text",
        F.when(F.col("neutral").contains("@"), dotted).otherwise("").alias("for_email"),
        F.when(has_digits, glued).otherwise("").alias("for_card"),
        _where(has_digits, "neutral").alias("for_ip"),
        _where(F.col("neutral").contains("+"), "neutral").alias("for_phone"),
    )
    digits = lambda v: F.char_length(F.regexp_replace(v, "[^0-9]", ""))
    return own.select(
        "doc_id",
        "text",
        _matches(F.col("for_email"), _EMAIL).alias("email"),
        _matches(F.col("for_ip"), _IP).alias("ip"),
        _matches(F.col("for_card"), _CARD).alias("card"),
        _matches(F.col("for_phone"), _PHONE).alias("phone"),
        _matches(_where(F.col("text").rlike(_CUED), "text"), _CUED).alias("cued"),
    ).select(
        "doc_id",
        "text",
        "email",
        F.filter("ip", lambda x: x["v"].rlike(_IP_PARTS)).alias("ip"),
        F.filter("card", lambda x: _luhn(x["v"])).alias("card"),
        F.filter("phone", lambda x: digits(x["v"]).between(9, 15)).alias("phone"),
        "cued",
    )


def _with_cues(rows: DataFrame) -> DataFrame:
    """Adds ``edges``: (cue, instance, s, e, seed) of seeds with a cue in front and of
    tokens of five digits or more behind a cue that touch no seed."""
    seeds = F.concat(*[F.col(k) for k in KINDS])
    behind = lambda x: F.regexp_extract(
        F.substring("text", F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24))),
        r"(?<![A-Za-z])([A-Za-z]{2,20}[:=#])\x20{0,2}$",
        1,
    )
    seeded = F.transform(
        F.col("seeds"),
        lambda x: F.struct(
            F.lower(behind(x)).alias("cue"),
            F.regexp_replace(x["v"], f"[{_GLUE}{_DOT}]", ".").alias("instance"),
            x["s"].alias("s"),
            x["e"].alias("e"),
            F.lit(True).alias("seed"),
        ),
    )

    def candidate(x: Column) -> Column:
        token = F.regexp_replace(F.regexp_replace(x["v"], _CUE, ""), "[./_-]+$", "")
        lead = F.char_length(x["v"]) - F.char_length(F.regexp_replace(x["v"], _CUE, ""))
        start = x["s"] + lead
        return F.struct(
            F.lower(F.regexp_extract(x["v"], "^[A-Za-z]+[:=#]", 0)).alias("cue"),
            token.alias("instance"),
            start.alias("s"),
            (start + F.char_length(token)).alias("e"),
            F.lit(False).alias("seed"),
        )

    unseen = F.filter(
        F.transform(F.col("cued"), candidate),
        lambda x: (F.char_length(F.regexp_replace(x["instance"], "[^0-9]", "")) >= 5)
        & ~F.exists("seeds", lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])),
    )
    rows = rows.withColumn("seeds", seeds)
    known = F.filter(seeded, lambda x: x["cue"] != "")
    return rows.withColumn("edges", F.concat(known, unseen))


def sure_cues(edges: DataFrame, rounds: int, min_support: int, confidence: float) -> DataFrame:
    """(cue, n_rows) of the patterns with ``min_support`` distinct seeds or more whose
    distinct instances are sure on average."""
    graph = edges.groupBy("cue", "instance").agg(F.max("seed").alias("seed"))
    graph = written(graph, "cue-graph")
    score = F.col("seed").cast("double")
    scored = graph.withColumn("score", score)
    for turn in range(rounds):
        cues = scored.groupBy("cue").agg(
            F.avg("score").alias("sure"),
            F.count_if("seed").alias("support"),
            F.count("*").alias("n_rows"),
        )
        cues = cues.withColumn("sure", F.when(F.col("support") >= min_support, F.col("sure")).otherwise(0.0))
        cues = written(cues, "cues")
        if turn == rounds - 1:
            break
        doubt = F.log1p(-F.least("sure", F.lit(0.999)))
        instances = (
            attach(graph, cues.select("cue", "sure", "n_rows"), "cue")
            .groupBy("instance")
            .agg((1 - F.exp(F.sum(doubt))).alias("together"), F.count("*").alias("n_rows"))
        )
        joined = attach(graph, written(instances, "instances"), "instance")
        scored = joined.select(
            "cue", "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.col("together")).alias("score")
        )
    return cues.filter(F.col("sure") >= confidence).select("cue", "n_rows")


def _joined(spans: Column, kind: str) -> Column:
    return F.transform(
        spans, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))
    )


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    min_support: int = 3,
    confidence: float = 0.7,
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans per row.

    Null counts as empty; a text without personal data has zeros, the digest of nothing and
    empty spans. Repeated rows are answered each and count as one instance of their cues.
    An empty table gives no rows; other columns are ignored. Found identifiers have the
    kind ``context`` and come last in ``spans``."""
    rows = _with_cues(base_rows(docs, id_col, text_col))
    rows = written(
        rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", *KINDS, "edges"),
        "pii-rows",
    )
    edges = rows.select("row_id", F.explode("edges").alias("x")).select("row_id", "x.*")
    cues = sure_cues(edges, rounds, min_support, confidence)
    unseen = edges.filter("NOT seed").select("row_id", "cue", "s", "e")
    found = attach(unseen, cues, "cue").groupBy("row_id").agg(
        # at most the identifiers of one document
        F.sort_array(F.collect_set(F.struct("s", "e"))).alias("context")
    )
    rows = rows.drop("edges").join(found, "row_id", "left")
    rows = rows.withColumn("context", F.coalesce("context", F.array().cast("array<struct<s:int,e:int>>")))
    base = F.concat(*[_joined(F.col(k), k) for k in KINDS])
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in (*KINDS, "context")],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _joined(F.col("context"), "context")), ",").alias("spans"),
    )
