"""Counterparty screening: every distinct name against the active watchlist, best match kept.

The list is dealt out by length of name, so a part holds names of one band of lengths (several parts
share one length that many names have). Distinct names are dealt out in chunks. A name first meets the
parts of its own length; the best score found there closes every part that its lengths alone cannot
reach it in, and the name visits the rest with that score as its mark. A task meets one chunk with one
part through an index (``name_index``), and a name's winners, one row a part, meet in one aggregate. So
no pair of names is ever a row, neither side has to fit in one place, nothing passes through the driver,
and the result is that of scoring every pair.
"""

from __future__ import annotations

from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.text import normalise_name
from riskweave.operators.name_index import COUNTRY_POINTS, NAME_WEIGHT, TYPE_POINTS, best_in_part
from riskweave.session import materialise

# Rows, about, of a part of the list and of a chunk of names.
SLICE_ROWS = 20_000
CHUNK_ROWS = 50_000
#: Below every score.
NO_MARK = -1.0

_KEYS = ["normal", "country", "entity_type"]
_BEST = (
    "normal string, country string, entity_type string, entity_id long, matched_entity string,"
    " alias_match boolean, country_match boolean, type_match boolean, name_position int,"
    " candidate_length int, lcs int, score double"
)
_BEST_COLUMNS = [c.split()[0] for c in _BEST.split(",")]


class ScreeningError(ValueError):
    """Names or a list that cannot be screened."""


def stripped(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def candidates(watchlist: DataFrame) -> DataFrame:
    """Active entities, one row per listed name: the canonical one, then each alias."""
    aliases = F.filter(
        F.transform(F.split("aliases", r"\|"), stripped), lambda s: s != ""
    )
    names = F.concat(F.array("canonical_name"), F.coalesce(aliases, F.array().cast("array<string>")))
    return (
        watchlist.where("active")
        .select("*", F.posexplode(names).alias("name_position", "listed_name"))
        .select(
            "entity_id", "canonical_name", "country", "entity_type", "listed_name",
            (F.col("name_position") > 0).alias("alias_match"),
            "name_position",
            normalise_name(F.col("listed_name")).alias("normal"),
        )
    )


def similarity(lcs: Column, length_a: Column, length_b: Column) -> Column:
    """Normalised Indel similarity, 0..100, from the longest common subsequence."""
    total = length_a + length_b
    return F.when(total == 0, 100.0).otherwise(100.0 * (1.0 - (total - 2 * lcs) / total))


def context_score(name_similarity: Column, same_country: Column, same_type: Column) -> Column:
    return (
        NAME_WEIGHT * name_similarity
        + COUNTRY_POINTS * same_country.cast("int")
        + TYPE_POINTS * same_type.cast("int")
    )


def screening_problems(names: DataFrame, listed: DataFrame, name_col: str) -> DataFrame:
    """Offending rows: names that fold to nothing, or the lack of any active candidate."""
    blank = (
        names.where(normalise_name(F.coalesce(F.col(name_col), F.lit(""))) == "")
        .select(F.lit("blank name").alias("problem"), F.col(name_col).alias("value"))
    )
    empty = (
        listed.agg(F.count(F.lit(1)).alias("n"))
        .where("n = 0")
        .select(F.lit("no active candidate").alias("problem"), F.lit(None).cast("string").alias("value"))
    )
    return blank.unionByName(empty)


def _bands(listed: DataFrame, slice_rows: int) -> list[tuple[int, int, int, int]]:
    """(first part, parts, shortest, longest): bands of lengths, each of about ``slice_rows`` rows a part."""
    lengths = listed.groupBy(F.length("normal").alias("length")).agg(F.count("*").alias("n"))
    out, held, low = [], 0, None
    rows = sorted(lengths.collect())  # one row a length of name
    for k, (length, n) in enumerate(rows):
        held, low = held + n, length if low is None else low
        if held >= slice_rows or k == len(rows) - 1:
            first = out[-1][0] + out[-1][1] if out else 0
            out.append((first, -(-held // slice_rows), low, length))
            held, low = 0, None
    return out


def _reach(length: Column, low: Column, high: Column) -> Column:
    """Best score of a name of some length in a band of lengths."""
    near = F.greatest(low, F.least(high, length))
    share = F.when(length + near == 0, 100.0).otherwise(200.0 * F.least(length, near) / (length + near))
    return NAME_WEIGHT * share + float(COUNTRY_POINTS + TYPE_POINTS) + 1e-9


def best_matches(requests: DataFrame, listed: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Best candidate of each distinct (normal, country, entity_type).

    The first candidate in list order (entity, then name position) wins ties.
    """
    spark = listed.sparkSession
    listed = materialise(listed.drop("listed_name"))
    requests = materialise(requests.select(*_KEYS).distinct())
    bands = _bands(listed, slice_rows)
    if not bands:
        raise ScreeningError("no active candidate")
    band = "first int, parts int, low int, high int"
    table = F.array(*(F.struct(*(F.lit(x).alias(c.split()[0]) for x, c in zip(b, band.split(", "), strict=True))) for b in bands))
    size = F.length("normal")
    own = F.coalesce(F.get(F.filter(table, lambda b: size <= b["high"]), F.lit(0)), table[len(bands) - 1])
    # Scoring costs time per row, not per byte: spread the names evenly whatever their size.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    parts = bands[-1][0] + bands[-1][1]
    chunks = max(-(-tasks // parts), -(-requests.count() // CHUNK_ROWS))
    within = F.pmod(F.xxhash64("entity_id", "name_position"), own["parts"]).cast("int")
    dealt = listed.withColumn("part", own["first"] + within)
    dealt = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    best = partial(best_in_part, keys=_KEYS, columns=_BEST_COLUMNS)
    first_best = F.struct("score", -F.col("entity_id"), -F.col("name_position"))

    def visited(names: DataFrame, wanted: Column) -> DataFrame:
        """Winners of names in the parts of the wanted bands."""
        spread = F.flatten(F.transform(wanted, lambda b: F.sequence(b["first"], b["first"] + b["parts"] - 1)))
        names = names.withColumn("chunk", F.pmod(F.xxhash64(*_KEYS), F.lit(chunks))).withColumn("part", F.explode(spread))

        def meet(names: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            return best(names, part)

        scored = names.groupBy("part", "chunk").cogroup(dealt.groupBy("part", "chunk")).applyInPandas(meet, _BEST)
        rest = F.struct(*[c for c in scored.columns if c not in _KEYS])
        return scored.groupBy(*_KEYS).agg(F.max_by(rest, first_best).alias("b")).select(*_KEYS, "b.*")

    near = materialise(visited(requests.withColumn("floor", F.lit(NO_MARK)), F.array(own)))
    if len(bands) == 1:
        return near
    asked = near.select(*_KEYS, F.col("score").alias("floor"))
    others = F.filter(table, lambda b: (b["first"] != own["first"]) & (_reach(size, b["low"], b["high"]) >= F.col("floor")))
    both = near.unionByName(visited(asked, others))
    rest = F.struct(*[c for c in near.columns if c not in _KEYS])
    return both.groupBy(*_KEYS).agg(F.max_by(rest, first_best).alias("b")).select(*_KEYS, "b.*")


def reason_codes(alias_match: Column, name_similarity: Column, country_match: Column) -> Column:
    how = (
        F.when(alias_match, "ALIAS_MATCH")
        .when(name_similarity == 100, "EXACT_NAME")
        .otherwise("FUZZY_NAME")
    )
    return F.array_compact(F.array(how, F.when(~country_match, F.lit("COUNTRY_MISMATCH"))))


def screen(
    names: DataFrame,
    watchlist: DataFrame,
    threshold: float,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Screen rows that carry ``counterparty_name``, ``country`` and, optionally, ``entity_type``.

    Each distinct folded name is scored once and joined back to all its rows. A blank name
    fails the job, as does a list without active candidates.
    """
    if not 0 <= threshold <= 100:
        raise ScreeningError("threshold must lie in 0..100")
    if "entity_type" not in names.columns:
        names = names.withColumn("entity_type", F.lit("BUSINESS"))
    normal = normalise_name(F.col("counterparty_name"))
    keyed = names.withColumn("normal", normal)
    keyed = keyed.withColumn(
        "normal",
        F.when(F.coalesce(F.col("normal"), F.lit("")) == "", F.raise_error(F.lit("blank name")))
        .otherwise(F.col("normal")),
    )
    listed = candidates(watchlist)
    matches = best_matches(keyed, listed, slice_rows)
    name_similarity = similarity(F.col("lcs"), F.length("normal"), F.col("candidate_length"))
    verdicts = (
        matches.withColumnRenamed("entity_id", "matched_entity_id")
        .withColumn("similarity", name_similarity)
        .withColumn(
            "score", context_score(F.col("similarity"), F.col("country_match"), F.col("type_match"))
        )
        .select(
            *_KEYS, "matched_entity", "matched_entity_id",
            F.round("similarity", 3).alias("name_similarity_score"),
            "alias_match", "country_match",
            F.round("score", 3).alias("screening_score"),
            F.lit(float(threshold)).alias("screening_threshold"),
            F.when(F.col("score") >= threshold, "REVIEW").otherwise("CLEAR").alias("recommendation"),
            reason_codes(F.col("alias_match"), F.col("similarity"), F.col("country_match"))
            .alias("reason_codes"),
        )
    )
    return keyed.join(verdicts, _KEYS).drop("normal")


def screen_counterparties(
    counterparties: DataFrame, watchlist: DataFrame, threshold: float, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One verdict per counterparty, all treated as businesses."""
    names = counterparties.select("counterparty_id", "counterparty_name", "country")
    return (
        screen(names, watchlist, threshold, slice_rows)
        .drop("country", "entity_type")
        .withColumnRenamed("counterparty_name", "counterparty")
    )


REQUEST_TYPES = ("PERSON", "BUSINESS")


def request_problem(name: Column, country: Column, entity_type: Column) -> Column:
    """Why an ad-hoc request is refused, or null."""
    text = stripped(F.coalesce(name, F.lit("")))
    return (
        F.when(text == "", "NAME_MISSING")
        .when(F.length(text) > 200, "NAME_TOO_LONG")
        .when(normalise_name(text) == "", "NAME_BLANK_AFTER_FOLDING")
        .when(~F.coalesce(stripped(country).rlike("^[A-Z]{2}$"), F.lit(False)), "COUNTRY_INVALID")
        .when(~entity_type.isin(*REQUEST_TYPES), "ENTITY_TYPE_INVALID")
    )


def screen_requests(
    requests: DataFrame, watchlist: DataFrame, threshold: float, country_codes: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Ad-hoc batch screening. Returns (verdicts, refused requests with the reason).

    ``country_codes=False`` accepts country names instead of two-letter codes.
    """
    frame = requests.withColumn("entity_type", F.coalesce("entity_type", F.lit("BUSINESS")))
    country = F.col("country") if country_codes else F.lit("XX")
    checked = frame.withColumn(
        "problem", request_problem(F.col("name"), country, F.col("entity_type"))
    )
    good = (
        checked.where("problem is null")
        .drop("problem")
        .withColumn("counterparty_name", F.trim("name"))
        .withColumn("country", F.trim("country"))
        .drop("name")
    )
    return screen(good, watchlist, threshold), checked.where("problem is not null")
