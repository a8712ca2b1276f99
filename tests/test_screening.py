import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.config import ControlError, Controls
from riskweave.functions.text import LcsTable, normalise_name
from riskweave.operators import screening
from riskweave.operators.name_index import NameIndex
from riskweave.schemas import WATCHLIST

LIST = [
    (0, "NORTHWIND TRADING", "North Wind Co|NWT ", "GB", "BUSINESS", True),
    (1, "Blue Harbour Ltd", "", "US", "BUSINESS", True),
    (2, "Jane Example", "J Example", "GB", "PERSON", True),
    (3, "Silent Partner", "", "GB", "BUSINESS", False),
]


def watchlist(spark, rows=LIST):
    full = [(i, n, a, c, t, "P", "S", active) for i, n, a, c, t, active in rows]
    return spark.createDataFrame(full, WATCHLIST)


def names(spark, rows):
    return spark.createDataFrame(
        [(i, n, c) for i, (n, c) in enumerate(rows)],
        "counterparty_id bigint, counterparty_name string, country string",
    )


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute_force(name, country, kind, listed):
    """The best candidate, by scoring all of them in list order."""
    best = None
    for c in listed:
        total = len(name) + len(c.normal)
        share = 100.0 * (1.0 - (total - 2 * lcs(name, c.normal)) / total)
        score = 0.9 * share + 5 * (country == c.country) + 5 * (kind == c.entity_type)
        if best is None or score > best[0]:
            best = (score, share, c)
    return best


def test_folding(spark):
    cases = {
        "  ÁCME,   Ltd. ": "acme ltd",
        "Straße 12": "strae 12",
        "ﬁne½": "fine12",
        "A\tB--C": "a b c",
        "北京": "",
        "plain name": "plain name",
    }
    frame = spark.createDataFrame(list(cases.items()), "name string, want string")
    rows = frame.select("want", normalise_name(F.col("name")).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


def test_lcs_kernel_equals_brute_force_at_any_length():
    rng = random.Random(5)
    words = ["".join(rng.choices("ab c1", k=n)) for n in (1, 3, 17, 63, 64, 65, 90, 200)]
    table = LcsTable(words, words)
    i, j = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words)), indexing="ij"))
    assert table.lengths_of(i, j).tolist() == [lcs(words[a], words[b]) for a, b in zip(i, j, strict=True)]


def test_exact_alias_fuzzy_and_clear(spark):
    rows = [
        ("Northwind Trading", "GB"), ("north wind co", "GB"), ("Northwind Tradng", "GB"),
        ("Completely Else", "GB"), ("Northwind Trading", "FR"), ("Silent Partner", "GB"),
    ]
    got = {
        r.counterparty_id: r
        for r in screening.screen_counterparties(names(spark, rows), watchlist(spark), 88).collect()
    }
    assert got[0].reason_codes == ["EXACT_NAME"] and got[0].screening_score == 100.0
    assert got[1].reason_codes == ["ALIAS_MATCH"] and got[1].matched_entity == "NORTHWIND TRADING"
    assert got[2].reason_codes == ["FUZZY_NAME"] and got[2].recommendation == "REVIEW"
    assert got[3].recommendation == "CLEAR" and got[3].matched_entity is not None
    assert got[4].reason_codes == ["EXACT_NAME", "COUNTRY_MISMATCH"] and got[4].screening_score == 95.0
    assert got[5].recommendation == "CLEAR" and got[5].matched_entity != "Silent Partner"


def test_threshold_uses_the_unrounded_score(spark):
    rows = names(spark, [("Northwind Tradng", "GB")])
    score = screening.screen_counterparties(rows, watchlist(spark), 0).first().screening_score
    for threshold, want in ((score - 0.01, "REVIEW"), (score + 0.01, "CLEAR")):
        got = screening.screen_counterparties(rows, watchlist(spark), threshold).first()
        assert got.recommendation == want


def test_first_candidate_wins_ties(spark):
    rows = [
        (7, "alpha one", "beta two", "GB", "BUSINESS", True),
        (4, "alpha one", "alpha one", "GB", "BUSINESS", True),
        (9, "beta two", "", "GB", "BUSINESS", True),
    ]
    got = screening.screen_counterparties(
        names(spark, [("alpha one", "GB"), ("beta two", "GB")]), watchlist(spark, rows), 88
    ).orderBy("counterparty_id").collect()
    assert [(r.matched_entity_id, r.alias_match) for r in got] == [(4, False), (7, True)]


@pytest.mark.parametrize("slice_rows", [1000, 7])
def test_best_match_equals_brute_force(spark, slice_rows):
    rng = random.Random(11)

    def word():
        return "".join(rng.choices("abcdef ", k=rng.choice([4, 9, 15, 70, 130]))).strip() or "a"

    listed_rows = [
        (i, word(), "|".join(word() for _ in range(rng.randrange(3))), rng.choice(["GB", "US"]),
         rng.choice(["BUSINESS", "PERSON"]), rng.random() < 0.9)
        for i in range(25)
    ]
    base = watchlist(spark, listed_rows)
    listed = screening.candidates(base)
    ordered = listed.orderBy("entity_id", "name_position").collect()
    wanted = [(f"{word()} x", rng.choice(["GB", "US"]), rng.choice(["BUSINESS", "PERSON"])) for _ in range(60)]
    requests = spark.createDataFrame(wanted, "normal string, country string, entity_type string")
    requests = requests.withColumn("normal", normalise_name(F.col("normal")))
    got = screening.best_matches(requests, listed, slice_rows).collect()
    assert len(got) == requests.distinct().count()
    for r in got:
        score, _, best = brute_force(r.normal, r.country, r.entity_type, ordered)
        assert (r.score, r.entity_id, r.name_position) == (score, best.entity_id, best.name_position)


def trade_names(rng, n):
    """Made-up firm names of one to three words and a suffix, from a few thousand words."""
    parts = "ba co da fi gu ha jo ka lu ma ne po qui ra si to vu wa xe yo zen tron ston berg field gate north wind".split()
    words = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(3_000)]
    return [" ".join([*rng.choices(words, k=rng.randrange(1, 4)), rng.choice(["ltd", "inc", "group", "gmbh"])]) for _ in range(n)]


def edited(rng, name, most):
    for _ in range(rng.randrange(most + 1)):
        at = rng.randrange(len(name))
        name = name[:at] + rng.choice(["", name[at] + "x", "q"]) + name[at + 1 :]
    return name.strip() or "a"


def scores_of(name, country, kind, table, row, countries, kinds):
    total = len(name) + table.lengths[1]
    lcs_ = table.lengths_of(np.full(len(countries), row), np.arange(len(countries)))
    return 0.9 * (100.0 * (1.0 - (total - 2 * lcs_) / total)) + 5 * (countries == country) + 5 * (kinds == kind)


def test_index_leaves_most_pairs_unseen_and_finds_the_same():
    """A list of 100,000: most names are one of it with a few changes, the others resemble none."""
    rng = random.Random(6)
    listed = trade_names(rng, 100_000)
    country, kind = (np.array(rng.choices(x, k=len(listed)), object) for x in (["GB", "US"], ["BUSINESS", "PERSON"]))
    names = [edited(rng, rng.choice(listed), 3) for _ in range(900)] + trade_names(random.Random(7), 100)
    asked = np.array(rng.choices(["GB", "FR"], k=len(names)), object), np.array(["BUSINESS"] * len(names), object)
    index = NameIndex(listed, country, kind)
    where, best, _ = index.search(names, *asked, np.full(len(names), -1.0))
    pairs = len(names) * len(listed)
    assert index.pairs_scored < 0.01 * pairs and index.pairs_bounded < 0.1 * pairs and index.leaves_bounded <= 0.25 * pairs
    table = LcsTable(names[:60] + names[-20:], index.list)
    for row, k in enumerate([*range(60), *range(980, 1_000)]):
        scores = scores_of(names[k], asked[0][k], asked[1][k], table, row, country, kind)
        assert (where[k], best[k]) == (int(np.argmax(scores)), scores.max())


def test_index_keeps_to_the_mark_and_to_list_order():
    names = ["alpha one", "alpha one", "beta two", "a", "", "x" * 300]
    index = NameIndex(names, np.array(["GB"] * 6, object), np.array(["PERSON"] * 6, object), leaf=2)
    ask = ["alpha one", "alpha one", "beta two", "a", "zzz"]
    country, kind = np.array(["GB", "GB", "XX", "GB", "GB"], object), np.array(["PERSON"] * 5, object)
    where, best, common = index.search(ask, country, kind, np.array([-1.0, 100.0, 95.0, 100.5, -1.0]))
    assert where[:4].tolist() == [0, 0, 2, -1] and best[:3].tolist() == [100, 100, 95] and common[2] == 8
    assert where[4] >= 0


def test_bands_that_cannot_win_are_not_visited(spark):
    """Names of one length on the list go to one band; a close match closes all bands of other lengths."""
    rows = [(k, f"{'ab' * (k % 30 + 1)}{k:03d}", "", "GB", "BUSINESS", True) for k in range(300)]
    listed = screening.candidates(watchlist(spark, rows))
    bands = screening._bands(listed, 40)
    assert sum(b[1] for b in bands) >= 7 and all(a[3] < b[2] for a, b in zip(bands, bands[1:]))
    exact = spark.createDataFrame([(rows[k][1], "GB", "BUSINESS") for k in range(300)], "normal string, country string, entity_type string")
    got = screening.best_matches(exact, listed, 40).collect()
    assert sorted(r.entity_id for r in got) == list(range(300)) and {r.score for r in got} == {100.0}


def test_blank_name_and_empty_list_fail(spark):
    with pytest.raises(Exception, match="blank name"):
        screening.screen_counterparties(names(spark, [("--", "GB")]), watchlist(spark), 88).collect()
    inactive = watchlist(spark, [LIST[3]])
    with pytest.raises(screening.ScreeningError):
        screening.screen_counterparties(names(spark, [("a", "GB")]), inactive, 88)
    problems = screening.screening_problems(
        names(spark, [("--", "GB"), ("ok", "GB")]), screening.candidates(inactive), "counterparty_name"
    )
    assert {r.problem for r in problems.collect()} == {"blank name", "no active candidate"}


@pytest.mark.parametrize("threshold", [-1, 100.5])
def test_threshold_range(spark, threshold):
    with pytest.raises(screening.ScreeningError):
        screening.screen_counterparties(names(spark, [("a", "GB")]), watchlist(spark), threshold)
    with pytest.raises(ControlError):
        Controls(screening_threshold=threshold)


def test_requests_are_checked_and_entity_type_counts(spark):
    rows = [
        ("Jane Example", "GB", "PERSON"), ("Jane Example", "GB", None), (" ", "GB", None), ("x" * 201, "GB", None),
        ("ok", "gb", None), ("ok", "GB", "ROBOT"), ("!!", "GB", None),
    ]
    requests = spark.createDataFrame(rows, "name string, country string, entity_type string")
    verdicts, refused = screening.screen_requests(requests, watchlist(spark), 88)
    got = {r.entity_type: r.screening_score for r in verdicts.collect()}
    assert got == {"PERSON": 100.0, "BUSINESS": 95.0}
    assert sorted(r.problem for r in refused.collect()) == [
        "COUNTRY_INVALID", "ENTITY_TYPE_INVALID", "NAME_BLANK_AFTER_FOLDING", "NAME_MISSING", "NAME_TOO_LONG",
    ]
