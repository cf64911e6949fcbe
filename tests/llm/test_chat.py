import hashlib

import pytest

from colmask.llm import chat
from tests.conftest import rows
from tests.llm.helpers import SF_DIR, duck, same_as_sql

TURNS = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digests(data):
    by_conv = {}
    for conv, turn, role, text in data:
        by_conv.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), sha(said), len(learned), sha(learned))
    return out


def test_query_against_sql(spark):
    assert same_as_sql(chat.op9_chat_windows(spark, SF_DIR), chat.OP9_SQL, duck())
    minus = {r["conv_id"]: r for r in chat.op9_chat_windows(spark, SF_DIR).collect()}[-7]
    assert minus["turns_sha256"] == sha(f"user\n{chat.MARK_LIKE}\nassistant\n{chat.MARK_LIKE}\n")
    assert (minus["loss_chars"], minus["loss_sha256"]) == (26, sha(chat.MARK_LIKE))


AWKWARD = [
    "", None, "</turn>\n<turn user>\n", "\\", "\\\\b\\l<", "<", ">", "\n", "a\r\nb", "\\b", "été \U0001f600", " ",
    "<turn assistant>\nx</turn>", "\\l", "l\\", "w " * 700,
]


@pytest.mark.parametrize("span, history", [(512, 128), (9, 12), (30, 5), (6, 0)])
def test_everything_comes_back(spark, span, history):
    roles = ["system", "user", "assistant", "<r>\n\\>", None, "assistant"]
    data = [(c, t, roles[(t + c) % 6], AWKWARD[(t * 7 + c) % len(AWKWARD)]) for c in range(12) for t in range(c * 3)]
    data += [(50, t, "assistant" if t % 2 else "user", f"t{t} " * (t % 9)) for t in range(700)]
    data += [(51, None, "user", "b"), (51, None, "user", "b"), (51, 5, "assistant", "x"), (51, 5, "assistant", "x")]
    data += [(None, 1, "system", "s"), (None, 2, "assistant", None), (52, -300, "system", "s"), (52, 300, "assistant", "t")]
    frame = spark.createDataFrame(data, TURNS)
    windows = chat.format_chats(frame, span, history)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.chat_digests(windows).collect()}
    assert got == plain_digests(data)
    for w in windows.collect():
        assert w["n_turns"] > w["n_repeated"] >= 0
        assert w["formatted"].count("<") == 2 * w["n_turns"]
        for start, length in w["loss"]:
            head = w["formatted"][:start]
            assert head.endswith("<turn assistant>\n") and w["formatted"][start + length :].startswith("</turn>\n")
            assert head.count("</turn>") >= w["n_repeated"]


def test_windows_keep_to_their_budgets(spark):
    data = [(1, 0, "system", "be kind")]
    data += [(1, t, "assistant" if t % 2 == 0 else "user", "word " * (t % 6 + 1)) for t in range(1, 60)]
    windows = sorted(chat.format_chats(spark.createDataFrame(data, TURNS), 40, 12).collect(), key=lambda w: w["window"])
    assert len(windows) > 5
    targets = 0
    for i, w in enumerate(windows):
        assert w["formatted"].startswith("<turn system>\nbe kind</turn>\n")
        assert not w["oversized"] and w["n_tokens"] <= 40 + 12 + 6
        assert w["n_repeated"] == 0 if i == 0 else 2 <= w["n_repeated"] <= 3
        targets += len(w["loss"])
    assert targets == sum(role == "assistant" for _, _, role, _ in data)
    long = spark.createDataFrame([(1, 0, "user", "w " * 90), (1, 1, "assistant", "ok")], TURNS)
    assert rows(chat.format_chats(long, 40, 12), "oversized", "n_repeated") == [(False, 0), (True, 0)]


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.format_chats(empty).count() == 0
    assert chat.chat_digests(chat.format_chats(empty)).count() == 0
    data = spark.createDataFrame([(1, 0, "user", "a", "z", 9)], TURNS + ", block string, tok int")
    assert chat.format_chats(data).first()["formatted"] == "<turn user>\na</turn>\n"


def test_plan_is_native(spark):
    plan = chat.op9_chat_windows(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
