import duckdb

from monthly_facts.llm import preference
from tests.llm.helpers import collected

TURNS = "conv_id bigint, turn bigint, role string, text string, prompt string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], TURNS)


def one(text_pairs):
    return [{"role": r, "text": t} for r, t in text_pairs]


def formatted(spark, chosen, rejected):
    side = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame([(1, chosen, rejected)], f"conv_id bigint, chosen {side}, rejected {side}")
    return collected(preference.formatted(df))[0]


def test_prefix_and_masks(spark):
    start = [("system", "s"), ("user", "hi")]
    got = formatted(spark, one(start + [("assistant", "good"), ("user", "thx")]), one(start + [("assistant", "bad")]))
    assert got["prefix_turns"] == 2
    assert got["prompt"] == "<|system|>\ns\n<|user|>\nhi\n"
    assert got["chosen"] == "<|assistant|>\ngood\n<|user|>\nthx\n"
    assert got["chosen_mask"] == "m14 l5 m13"
    assert got["rejected"] == "<|assistant|>\nbad\n" and got["rejected_mask"] == "m14 l4"


def test_prefix_edges(spark):
    a = [("user", "q"), ("assistant", "r")]
    same = formatted(spark, one(a), one(a))
    assert (same["prefix_turns"], same["chosen"], same["rejected"], same["chosen_mask"]) == (2, "", "", "")
    longer = formatted(spark, one(a), one(a + [("user", "more")]))
    assert (longer["prefix_turns"], longer["chosen"], longer["rejected"]) == (2, "", "<|user|>\nmore\n")
    none = formatted(spark, one([("user", "x")] + a), one([("user", "y")] + a))
    assert none["prefix_turns"] == 0 and none["prompt"] == ""
    missing = formatted(spark, one(a), None)
    assert missing["prefix_turns"] == 0 and missing["rejected"] == "" and missing["rejected_mask"] == ""
    nulls = formatted(spark, one([(None, None), ("user", None)]), one([(None, None), ("user", "")]))
    assert nulls["prefix_turns"] == 1 and nulls["prompt"] == "<||>\n\n"


ROWS = [
    (0, 0, "user", "q0"), (0, 1, "assistant", "r0"), (0, 2, "user", "u"), (0, 3, "assistant", "last0"),
    (1, 1, "assistant", "r1"), (1, 0, "user", "q1"),
    (2, 0, "user", "only a question"),
    (3, 0, "user", "q3"), (3, 1, "assistant", "r3"),
    (4, 0, "system", "sys"), (4, 1, "user", None), (4, 2, "assistant", None), (4, None, "user", "late"),
    (None, 0, "user", "nobody"), (6, 0, "assistant", "dup"), (6, 0, "assistant", "dup"), (6, 0, None, "x"),
    (7, 0, "user", "long " * 20000), (7, 1, "assistant", "ü👩 " * 1000),
]


def test_sql_agrees_on_awkward_turns(spark):
    df = frame(spark, ROWS)
    got = preference.formatted(preference.with_other_reply(preference.conversations(df)))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.execute(preference.PREFERENCE_SQL).fetchall()))
    by = {r["conv_id"]: r for r in collected(got)}
    assert by[0]["prefix_turns"] == 3 and by[0]["rejected"] == "<|assistant|>\nr1\n"
    assert by[2]["chosen"] == by[2]["rejected"] == ""
    assert by[4]["prefix_turns"] == 2 and by[4]["rejected"].startswith("<|assistant|>\n\n")


def test_empty(spark):
    assert preference.formatted(preference.with_other_reply(preference.conversations(frame(spark, [])))).collect() == []
