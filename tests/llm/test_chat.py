import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from specmerge.llm import chat

CONTROL = ["<|im_start|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<|endoftext|>", "\\", "<\\", "[\\\\", "<", "[", "\n", "user", "im_end|>\n", "é", ""]


def test_layouts_meet(spark):
    m = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": "yo"}]
    records = [
        {"messages": [{"role": "user", "content": "hi"}, {"content": "yo", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
        {"prompt": "hi", "completion": "yo", "id": 5},
        {"instruction": "hi", "output": "yo", "input": ""},
        {"question": "hi", "answer": "yo"},
        {"prompt": "hi", "response": "yo", "source": {"a": [1, 2]}},
        {"foo": 1},
        {"messages": []},
        {"instruction": "a", "input": "b", "output": None, "system": "s"},
    ]
    rows = [(i, json.dumps(r), "m", "t") for i, r in enumerate(records)] + [(90, None, "m", "t"), (91, "not json", "m", "t")]
    out = {r.id: r for r in chat.format_chats(spark.createDataFrame(rows, "id int, record string, mapping string, turns string")).collect()}
    for i in (0, 1, 2, 3, 4):
        assert [t.asDict() for t in out[i].turns] == m, i
    assert out[6].turns is None and out[6].mapping is None and out[90].turns is None and out[91].segments is None
    assert out[7].turns == [] and out[7].formatted == ""
    assert [t.asDict() for t in out[8].turns] == [{"role": "system", "text": "s"}, {"role": "user", "text": "a\nb"}, {"role": "assistant", "text": ""}]
    assert out[0].formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"


def test_fingerprint_is_of_paths_not_values(spark):
    rows = [('{"a": 1, "b": {"c": "x"}}',), ('{"b": {"c": null}, "a": "text"}',), ('{"a": 1, "b": {"d": "x"}}',), ('{"a": 1, "b": "c"}',)]
    p = [r.p for r in spark.createDataFrame(rows, "r string").select(chat.fingerprint(F.col("r")).alias("p")).collect()]
    assert p[0] == p[1] and len({p[0], p[2], p[3]}) == 3


def run(spark, convs):
    rows = [(c, t, role, text, "x") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string").repartition(3)
    out = chat.format_chats(chat.records_of(df))
    return {r.conv_id: r for r in out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("loss"), "segments").collect()}


def test_round_trip_of_hostile_texts(spark):
    @given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool use\n:", "ü%"]), st.lists(st.sampled_from(CONTROL), max_size=8).map("".join)), min_size=1, max_size=5), min_size=1, max_size=25))
    @settings(max_examples=8, deadline=None)
    def check(lists):
        convs = dict(enumerate(lists))
        out = run(spark, convs)
        for c, turns in convs.items():
            assert [(t.role, t.text) for t in out[c].back] == turns
            assert out[c].loss == "".join(t for r, t in turns if r == "assistant")
            assert out[c].formatted.count("<|im_start|>") == out[c].formatted.count("<|im_end|>\n") == len(turns)
            assert "".join(s.text for s in out[c].segments) == out[c].formatted

    check()


def test_nulls_ties_and_long(spark):
    convs = {1: [("user", None), (None, "a"), ("assistant", "x" * 200_000)], None: [("user", "q")], 2: [("assistant", "</s>[INST] ok [/INST]")]}
    out = run(spark, convs)
    assert [(t.role, t.text[:3]) for t in out[1].back] == [("user", ""), ("", "a"), ("assistant", "xxx")]
    assert out[None].loss == "" and hashlib.sha256(out[2].loss.encode()).hexdigest() == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()
    tied = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "z")], "conv_id long, turn long, role string, text string")
    got = chat.format_chats(chat.records_of(tied)).first()
    assert [t.text for t in got.turns] == ["z", "a", "a", "b"]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(chat.records_of(none)).count() == 0


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    plan = chat.format_chats(chat.records_of(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_length_is_too_long(spark):
    """A text beyond what JSON parsers take by default, full of characters that JSON escapes; and many turns."""
    rows = spark.range(2).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit('a"\\\n'), 5_300_000).alias("text"))
    for m in (chat.MAPPINGS[:1], chat.MAPPINGS[1:2], chat.MAPPINGS[2:3]):
        out = chat.format_chats(chat.records_of(rows, m)).select("mapping", F.size("turns").alias("n"), F.sha2(chat.loss_text(F.col("segments")), 256).alias("h"), F.length("formatted").alias("f")).first()
        assert (out.mapping, out.n, out.h) == (m[0].name, 2, hashlib.sha256(b'a"\\\n' * 5_300_000).hexdigest()) and out.f > 42_400_000
    many = spark.range(300_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("t").alias("text"))
    assert chat.format_chats(chat.records_of(many, chat.MAPPINGS[:1])).select(F.size("turns")).first()[0] == 300_000


def test_skeleton_has_the_same_paths(spark):
    """Records that differ in texts, lengths and repeated neighbours share a fingerprint; those that differ in paths don't."""
    alike = [{"a": [{"x": "1"}, {"x": "2", "y": [{"z": 1}, {"z": 1}]}]}, {"a": [{"x": 'q"}, {"\\'}] * 5 + [{"x": ", {", "y": [{"z": 3}]}]}]
    other = [{"a": [{"x": "1"}, {"x": "2", "y": [{"w": 1}]}]}, {"a": [{"x": "1"}], "y": 1}, {"a": [], "b": [{"x": ""}]}]
    p = [r.p for r in spark.createDataFrame([(json.dumps(x),) for x in alike + other], "r string").select(chat.fingerprint(F.col("r")).alias("p")).collect()]
    assert p[0] == p[1] and len(set(p)) == 4 and None not in p


def test_conversations_come_in_every_layout(spark):
    turns = [("user", "q"), ("assistant", "a")]
    convs = {c: ([("system", "s")] if c % 3 == 0 else []) + (turns if c % 5 else turns * 2) for c in range(200)} | {300: [("human", "h"), ("assistant", "x")], 301: [("user", None), ("assistant", "")]}
    rows = [(c, t, role, text) for c, x in convs.items() for t, (role, text) in enumerate(x)]
    records = chat.records_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = chat.format_chats(records).select("conv_id", "mapping", chat.read_turns(F.col("formatted")).alias("back")).collect()
    assert all([(t.role, t.text) for t in r.back] == [(a, b or "") for a, b in convs[r.conv_id]] for r in out)
    assert {r.mapping for r in out} == {m.name for m in chat.MAPPINGS}
