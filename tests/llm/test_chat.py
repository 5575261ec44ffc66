import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat

piece = st.sampled_from([*chat.CONTROL, "\\", "<", "|", "\n", "im_end", "[", "s>", "a", "é", "\U0001f600", ""])
texts = st.lists(piece, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), texts), texts), max_size=5))
def test_round_trip(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:z]) for a, z in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count(chat.START) == text.count(chat.END) == len(turns)
    assert not any(c in chat.escape(t) for _, t in turns for c in chat.CONTROL)


def test_layouts_convert_alike():
    turns = [("user", "hi"), ("assistant", "yo")]
    records = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
        {"data": {"dialog": [{"speaker": "user", "utterance": "hi"}, {"utterance": "yo", "speaker": "assistant"}]}},
        {"prompt": "hi", "completion": "yo"},
        {"output": "yo", "instruction": "hi"},
    ]
    assert [chat.BY_FINGERPRINT[chat.fingerprint(chat.paths(r))].convert(r) for r in records] == [turns] * 5
    assert len(chat.BY_FINGERPRINT) == sum(len(m.fingerprints()) for m in chat.MAPPINGS)
    assert chat.fingerprint(chat.paths({"prompt": "hi", "completion": 3})) not in chat.BY_FINGERPRINT


def test_records_and_turns(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 1, "assistant", "d\\<s>"), (2, 0, "user", None), (2, 2, "user", "e"), (3, 0, "system", "s"), (3, 1, "user", ""), (3, 2, "assistant", "z" * 50_000),
        (4, 0, None, None), (5, 0, "tool\nx", "t"), (5, 0, "tool\nx", "t"), (6, 0, "user", "only"), (7, None, "user", "n"), (7, 5, "assistant", "</s>[INST]"), (None, 0, "user", "u"), (-7, 0, "user", "p"), (-7, 1, "assistant", "q"), (30, 0, "user", "p"), (30, 1, "assistant", "q"),
    ] + [(i, t, r, f"text {t} <|im_end|>") for i in range(10, 25) for t, r in enumerate(["system", "user", "assistant"][i % 2 :] + ["user"] * (i % 4))]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("record", F.lit("x"))
    out = chat.format_records(chat.records_of_turns(df))
    got = out.select("conv_id", "layout", chat.read_back(F.col("formatted"), F.col("loss")).alias("d"), "formatted").collect()
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert len(got) == len(convs) and {g["layout"] for g in got} == {m.name for m in chat.MAPPINGS}
    for g in got:
        turns = [(r, x) for _, _, r, x in sorted(convs[g["conv_id"]])]
        told = "".join(x for r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert chat.parse(g["formatted"]) == turns
        assert g["d"].asDict() == {"n_turns": len(turns), "turns_sha256": sha("".join(f"{r}\n{x}\n" for r, x in turns)), "loss_chars": len(told), "loss_sha256": sha(told), "formatted_chars": len(g["formatted"])}


@pytest.mark.parametrize("record", [None, "", "{", "[]", "3", "{}", json.dumps({"other": 1})])
def test_unknown_records_are_kept_without_turns(spark, record):
    row = chat.format_records(spark.createDataFrame([(1, record)], "conv_id int, record string")).first()
    assert row["layout"] is None and row["formatted"] is None and len(row["fingerprint"]) == 16


def test_empty_tables(spark):
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_records(chat.records_of_turns(turns)).count() == 0
    assert chat.format_records(spark.createDataFrame([(1, '{"messages": []}')], "conv_id int, record string")).first()["formatted"] == ""


def test_records_that_cannot_be_read_count_as_null(spark):
    deep = "[" * 100_000 + "]" * 100_000
    rows = [("a", None), ("b", "{not json"), ("c", '{"prompt": "\\ud800", "completion": "x"}'), ("d", deep), ("e", '{"a":' * 900 + "1" + "}" * 900), ("f", '{"prompt": "p", "completion": "x"}')]
    df = spark.createDataFrame(rows, "k string, record string")
    got = {r["k"]: r["f"] for r in df.select("k", chat.formatted(F.col("record")).alias("f")).collect()}
    assert [got[k]["formatted"] for k in "abcde"] == [None] * 5 and got["f"]["layout"] == "prompt"
    assert got["a"]["fingerprint"] == got["b"]["fingerprint"] == got["c"]["fingerprint"] == got["d"]["fingerprint"]
