"""Secret scans: spans of credentials, and weak candidates that stand beside their counterpart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, text_of

# Kinds in the order in which equal starts are listed: pattern, least length, group it counts in.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
BASE = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",  # equals runs of 20 and more: a shorter run holds no longer one
    "hex": r"[0-9a-f]{24,}",
}
# Weak candidates: alone they are words, hashes or links; together they open an account.
WEAK = {
    "identifier": r"(?i:\b(?:access_?key(?:_?id)?|client_?id|user(?:name)?|login|account)["
                  r"""'"]?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,})""",
    "key": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[A-Z])(?=[A-Za-z0-9+/_=-]*[a-z])"
           r"[A-Za-z0-9+/_=-]{20,}",
    "endpoint": r"(?i:\b(?:https?|ftp|jdbc|mongodb|postgres(?:ql)?|mysql|redis|amqp)[a-z:]*://[^\x20\x09-\x0D\"'<>]+)",
}
KINDS = [*BASE, *WEAK]
# Which part of a credential a kind can be.
PARTS = {"access": "id", "identifier": "id", "assign": "secret", "hex": "secret", "key": "secret", "endpoint": "place"}


def _spans(kind: str, matches: Column, pieces: Column) -> Column:
    """Spans of all matches as structs, by start, in code points.

    The pieces between matches and the matches alternate, so their lengths add up to the offsets.
    """
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def one_more(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["p"])
        end = start + F.length(pair["m"])
        grown = F.concat(acc["found"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct(end.alias("at"), grown.alias("found"))

    found = F.aggregate(
        F.arrays_zip(matches.alias("m"), F.slice(pieces, 1, F.size(matches)).alias("p")),
        F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found")), one_more, lambda acc: acc["found"])
    return F.transform(
        F.when(F.size(matches) > 0, found).otherwise(none),
        lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                           F.lit(kind).alias("kind"), s["end"].alias("end")))


def parts(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, weak``: the spans of each row's whole text, null as empty."""
    patterns = BASE | WEAK
    matched = docs.select(
        F.xxhash64("doc_id", "text").alias("row"), "doc_id", text_of().alias("text"),
        *[F.regexp_extract_all(text_of(), F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in patterns.items()],
        F.regexp_extract_all(text_of(), F.lit(ASSIGN), F.lit(2)).alias("values"),
    )
    cut = matched.select(  # only texts with a match are split
        "row", "doc_id", "values", *[f"m_{k}" for k in patterns],
        *[F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)).alias(f"p_{k}") for k, p in patterns.items()])
    spans = cut.select("row", "doc_id", "values", *[_spans(k, F.col(f"m_{k}"), F.col(f"p_{k}")).alias(k) for k in patterns])
    # a short value still uses up its text, hence it is dropped afterwards
    kept = spans.withColumn("assign", F.filter("assign", lambda s, i: F.length(F.get("values", i)) >= 6))
    return kept.select("row", "doc_id", *BASE, F.sort_array(F.concat(*BASE)).alias("base"), F.concat(*WEAK).alias("weak"))


def linked(found: DataFrame, reach: int = 200) -> DataFrame:
    """Weak candidates with a complementary part within ``reach`` code points of the same document.

    A weak secret needs an identifier or an endpoint, a weak identifier or endpoint needs a secret.
    Parts are joined by document and stretch of ``reach`` code points: a candidate looks in the
    stretches it touches and in those beside them, and spans that overlap it are not its
    complement. A stretch holds at most ``reach`` starts, so a text full of parts is dealt to many
    groups, none of which grows with it. Returns one row per linked candidate.
    """
    part = F.create_map(*[F.lit(x) for pair in PARTS.items() for x in pair])
    rows = found.select("row", "doc_id", F.explode(F.concat("base", "weak")).alias("s")).select(
        "row", "doc_id", "s.*", F.element_at(part, F.col("s.kind")).alias("part")).distinct()
    stretch = F.lit(reach)
    near = rows.select(
        "row", F.col("kind").alias("o_kind"), F.col("part").alias("o_part"),
        F.col("start").alias("o_start"), F.col("end").alias("o_end"),
        F.explode(F.sequence(F.floor(F.col("start") / stretch), F.floor(F.col("end") / stretch))).alias("at"),
    )
    weak = rows.filter(F.col("kind").isin(*WEAK)).withColumn("at", F.explode(F.sequence(
        F.floor(F.col("start") / stretch) - 1, F.floor(F.col("end") / stretch) + 1)))
    complement = (F.col("part") == "secret") != (F.col("o_part") == "secret")
    apart = F.greatest(F.col("start"), F.col("o_start")) - F.least(F.col("end"), F.col("o_end"))
    return (
        weak.join(near, ["row", "at"]).filter(complement & apart.between(0, reach))
        .select("row", "doc_id", "rank", "kind", "start", "end").distinct()
    )


def listed(spans: Column | str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(docs: DataFrame, reach: int = 200) -> DataFrame:
    """One row per row of ``docs``: counts of strong spans, their digest, and all reported spans.

    Base spans (assignments, access keys, long hex runs) are always reported; weak candidates
    (identifiers, key-like runs, endpoints) only beside a complementary part, and not where they
    overlap a base span. Rows that repeat an id and a text have the same spans; null and empty texts
    have none. The text is read once: only spans go on to the join.
    """
    found = materialise(parts(docs), "secrets")
    links = linked(found.filter(F.size("weak") > 0), reach).groupBy(
        F.col("row").alias("l_row"), F.col("doc_id").alias("l_doc")
    ).agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("more"))
    clear = F.filter(
        F.coalesce("more", F.array().cast(found.schema["base"].dataType)),
        lambda w: ~F.exists("base", lambda b: (w["start"] < b["end"]) & (b["start"] < w["end"])))
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE]
    own = found.join(links, (found["row"] == links["l_row"]) & found["doc_id"].eqNullSafe(links["l_doc"]), "left")
    return own.withColumn("extra", clear).select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat("base", "extra"))).alias("spans"), F.size("extra").cast("bigint").alias("n_linked"))
