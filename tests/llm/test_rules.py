import re

from colmask.llm import rules as r
from tests.conftest import rows
from tests.llm.helpers import SF_DIR, docs_frame, no_docs, odd_docs, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = {p + k for starts in places.values() if len(starts) > 1 for p in starts for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_query_counts(spark):
    texts = {row["doc_id"]: row["text"] for row in table(spark, "documents").collect()}
    got = r.op8_quality_rules(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for row in got:
        want = plain_counts(texts[row["doc_id"]])
        assert tuple(row[c] for c in COUNTS) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])


def test_learned_rules_tell_bad_from_good(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    got = r.op8_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [x for x in got if x["quality"] == 1 and not x["base_failed"]]
    bad = [x for x in got if x["quality"] == 0]
    assert sum(x["kept"] for x in good) >= 0.99 * len(good)
    assert sum(not x["kept"] for x in bad) >= 0.9 * len(bad)


def test_odd_rows(spark):
    docs = odd_docs(spark, ["stats", "_words", "_counts", "_stats", "kept"])
    labels = spark.createDataFrame([(1, 0), (None, 0), (3, None), (99, 1)], "doc_id bigint, quality int")
    got = rows(r.quality_verdicts(docs, labels))
    texts = [(row["doc_id"], row["text"]) for row in docs.collect()]
    assert sorted((i, *plain_counts(t)) for i, t in texts if i is not None) == [g[:6] for g in got if g[0] is not None]
    assert len(got) == len(texts)
    assert all(g[6] for g in got if g[1] < 20)
    kept = r.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == []
    assert r.quality_verdicts(no_docs(spark), labels).count() == 0
    assert r.keep_quality(no_docs(spark), labels).count() == 0


def test_repeated_windows_overlap(spark):
    words = [f"a{i}" for i in range(12)]
    texts = [
        " ".join(words * 2), " ".join(["x"] * 40), " ".join(words[:8] + ["y"] + words[:8] + ["z"] + words[:9]),
        " ".join(words[:7]), "same line\nsame line\n\n \nsame line \nother", "# a | <b> $\n# a | <b> $",
    ]
    docs = docs_frame(spark, list(enumerate(texts)))
    got = r.with_stats(docs, "text", "s").select("doc_id", *[f"s.{c}" for c in COUNTS])
    assert rows(got) == [(i, *plain_counts(t)) for i, t in enumerate(texts)]


def labelled(spark, data):
    """Rows of ``(id, quality, symbol_share, upper_share)``; other features are equal."""
    kind = "struct<" + ",".join(
        f"{f}:{'bigint' if f in COUNTS else 'double'}" for f in (*COUNTS, *[x for x in r.FEATURES if x not in COUNTS])
    ) + ">"
    made = []
    for i, quality, symbols, upper in data:
        values = dict.fromkeys(r.FEATURES, 0.5) | dict.fromkeys(COUNTS, 0)
        values |= {"n_words": 100, "symbol_share": symbols, "upper_share": upper}
        made.append((i, quality, values))
    return spark.createDataFrame(made, f"doc_id bigint, quality int, stats {kind}")


def test_rules_are_grown_in_order_and_cut_between(spark):
    data = []
    for i in range(300):
        data += [(3 * i, 1, 0.0, 0.05), (3 * i + 1, 0, 0.4, 0.05)] + ([(3 * i + 2, 0, 0.0, 0.9)] if i % 3 == 0 else [])
    found = r.learn_rules(labelled(spark, data), "stats")
    assert [(t[0].feature, t[0].below, len(t)) for t in found.rules] == [
        ("symbol_share", False, 1), ("upper_share", False, 1),
    ]
    assert 0.0 < found.rules[0][0].threshold < 0.4 and 0.05 < found.rules[1][0].threshold < 0.9
    assert str(found).startswith("1. reject if symbol_share > 0.2")


def test_a_conjunction_is_needed(spark):
    data = [(i, 0 if a and b else 1, 0.4 * a, 0.9 * b) for i, (a, b) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)] * 150)]
    (rule,) = r.learn_rules(labelled(spark, data), "stats").rules
    assert {t.feature for t in rule} == {"symbol_share", "upper_share"}


def test_no_rule_from_noise_or_one_kind(spark):
    noise = [(i, int(i * 2654435761 % 97 > 40), i * 31 % 17 / 17, i * 7 % 13 / 13) for i in range(600)]
    assert r.learn_rules(labelled(spark, noise), "stats").rules == ()
    assert r.learn_rules(labelled(spark, [(i, 1, 0.1, 0.1) for i in range(50)]), "stats").rules == ()
    assert r.learn_rules(labelled(spark, []), "stats").rules == ()


def test_rare_kinds_get_rules(spark):
    """Kinds of bad text of a hundredth of the bad rows, each inside the range of the good ones, beside a kind no rule can tell."""
    data = []
    for i in range(6000):
        data.append((10 * i, 1, i * 31 % 1000 / 1000, i * 7 % 1000 / 1000))
        if i % 3 == 0:
            data.append((10 * i + 1, 0, i * 31 % 1000 / 1000, i * 7 % 1000 / 1000))
        if i % 300 == 0:
            data.append((10 * i + 2, 0, 2.0 + i / 1e6, 0.5))
            data.append((10 * i + 3, 0, 0.5, 2.0 + i / 1e6))
    data += [(99, 1, 3.0, 0.5), (98, 1, 0.5, 3.0)]
    found = r.learn_rules(labelled(spark, data), "stats")
    rare = labelled(spark, [(1, 0, 2.01, 0.5), (2, 0, 0.5, 2.01), (3, 1, 0.9, 0.9), (4, 1, 0.1, 0.5)])
    assert [x[0] > 0 for x in rare.orderBy("doc_id").select(found.rejected_by("stats")).collect()] == [True, True, False, False]


def test_more_than_eight_kinds(spark):
    """Twelve bands of bad rows between good ones."""
    data = [(i, int(i % 25 % 2 == 0), i % 25 / 25, 0.1) for i in range(3000)]
    found = r.learn_rules(labelled(spark, data), "stats")
    assert len(found.rules) >= 12
    got = labelled(spark, data).select("quality", found.rejected_by("stats").alias("rule")).collect()
    assert all((x["rule"] > 0) == (x["quality"] == 0) for x in got)


def test_plan_is_native_and_makes_counts_once(spark):
    docs = table(spark, "documents")
    rule = r.DecisionList(((r.Cut("symbol_share", False, 0.1), r.Cut("upper_share", True, 0.5)),))
    plan = r.with_stats(docs, "text", "s").filter(rule.kept("s"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("regexp_extract_all") == 4
