import re

import pytest

from colmask.llm import tokens as t
from tests.conftest import rows
from tests.llm.helpers import SF_DIR, docs_frame, no_docs, odd_docs, table

JSON = "/opt/tokenizers/byte_bpe_50k.json"


def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(JSON)
    made.encode_special_tokens = True
    return made


def owner(span, sections, rule):
    """Section of a token by looking at all of them."""
    a, b = span
    shared = [min(b, stop) - max(a, start) for start, stop in sections]
    if rule == "largest":
        return shared.index(max(shared)) if shared and max(shared) > 0 else -1
    place = a if rule == "first" else b - 1
    return next((i for i, (start, stop) in enumerate(sections) if start <= place < stop), -1)


def lines(text):
    out, at = [], 0
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        out.append((at, at + len(line)))
        at += len(line)
    return out


def test_query_against_another_tokenizer(spark):
    got = {(r["doc_id"], r["section"]): tuple(r)[2:5] for r in t.op3_token_counts(spark, SF_DIR).collect()}
    want, other = {}, tokenizer()
    for row in table(spark, "documents").collect():
        sections = lines(row["text"])
        owners = [owner(span, sections, "first") for span in other.encode(row["text"], add_special_tokens=False).offsets]
        want |= {(row["doc_id"], i): (*s, owners.count(i)) for i, s in enumerate(sections)}
    assert got == want


@pytest.mark.parametrize("rule", t.RULES)
def test_rules_with_given_sections(spark, rule):
    texts = ["ab cd\n\n\n  ef, don't 12345!", "é日本\U0001f600x y", "hello   world" * 3, "\n" * 9, "a"]
    parts = [[(0, 4), (4, 7), (9, 12)], [(1, 2), (2, 4), (4, 99)], [(2, 3), (3, 3), (6, 20)], [(0, 1), (1, 2), (5, 9)], []]
    frame = spark.createDataFrame(
        [(i, x, s) for i, (x, s) in enumerate(zip(texts, parts))],
        "doc_id long, text string, parts array<struct<start:int,stop:int>>",
    )
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in t.token_counts(frame, "parts", rule).collect()}
    want, other = {}, tokenizer()
    for i, (text, sections) in enumerate(zip(texts, parts)):
        sections = [(min(a, len(text)), min(b, len(text))) for a, b in sections]
        owners = [owner(span, sections, rule) for span in other.encode(text, add_special_tokens=False).offsets]
        want |= {(i, k): owners.count(k) for k in range(len(sections))}
        if -1 in owners:
            want[(i, -1)] = owners.count(-1)
    assert got == want


def test_crossing_tokens(spark):
    docs = docs_frame(spark, [(1, "ab\n\n\ncd")])
    assert rows(t.token_counts(docs), "section", "start", "stop", "n_tokens", "n_crossing") == [
        (0, 0, 3, 2, 1), (1, 3, 4, 0, 0), (2, 4, 5, 1, 0), (3, 5, 7, 1, 0),
    ]


def test_odd_rows(spark):
    docs = odd_docs(spark, ["section", "n_tokens", "sections"])
    got = rows(t.token_counts(docs), "doc_id", "section", "n_tokens")
    assert got.count((1, 0, 5)) == 2 and (None, 0, 5) in got
    assert {g[0] for g in got} == {None, 1, 4, 5, 6, 7}
    assert [g for g in got if g[0] == 5][0][2] > 60_000
    assert t.token_counts(no_docs(spark)).count() == 0
    null_parts = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, p array<struct<start:int,stop:int>>")
    assert rows(t.token_counts(null_parts, "p"), "section", "start", "n_tokens") == [(-1, None, 2)]
    with pytest.raises(ValueError):
        t.token_counts(docs, rule="half")


def test_long_white_space():
    made, other = t.Tokenizer(t.read_ranks(t.RANKS)), tokenizer()
    for n in (t.LONG_SPACE - 1, t.LONG_SPACE, t.LONG_SPACE + 1, 5000):
        for space in (" ", "\n", " \t\r\n", "\x85\xa0\u2003\u3000", "\x1c "):
            run = (space * n)[:n]
            for text in (run, f"a{run}", f"{run}b", f"a {run}b{run} c{run}", f"x\x1c{run}\x1cy"):
                stops = [b for _, b in other.encode(text, add_special_tokens=False).offsets]
                chars = t._chars(text.encode())
                assert chars[made.byte_stops(text)].tolist() == stops


def test_very_long_white_space(spark):
    runs = [" " * 5_000_000, "\n" * 5_000_000, " \n\t" * 1_700_000, "x" + " " * 3_000_000 + "y", "z" * 2_000_000, "-" * 2_000_000]
    docs = docs_frame(spark, [(i, x) for i, x in enumerate(runs)] + [(99, "a b")])
    got = t.token_counts(docs).groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0] for r in got} == {*range(len(runs)), 99} and {r[1] for r in got if r[0] == 99} == {2}
