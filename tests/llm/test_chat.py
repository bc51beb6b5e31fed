"""Chat formatting: exact round trips, the state machine, and the SQL form."""

import hashlib

import pytest
from compare_engines import connect, differences
from pyspark.sql import functions as F

from lastmile.llm import chat
from lastmile.llm.queries import QUERIES
from lastmile.llm.sql import ORACLES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [
    "", "\\", "\\\\<s>", "<s>", "<\\s>", "<<SYS>>", "<<s>", "<|im_end|>\n", "a<|im_start|>user\nb", "[INST][/INST]",
    "[\\INST]", "<", "[", "x\n", "\\n", "é😀<</SYS>>", "<|im_end|>" * 3, "tail \\",
]


def test_query_against_sql(spark):
    name = "op3_chat_formatting"
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


def test_round_trip(spark):
    turns = [(0, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(ODD)]
    turns += [(1, i, t, t) for i, t in enumerate(ODD)]
    out = chat.formatted(spark.createDataFrame(turns, SCHEMA)).withColumn("whole", chat.text_of())
    back = out.select("conv_id", chat.read_back(F.col("whole")).alias("t"), "whole", "segments").collect()
    for row in back:
        want = [(r, t) for c, _, r, t in turns if c == row.conv_id]
        assert [(x.role, x.text) for x in row.t] == want
        assert "".join(s.text for s in row.segments) == row.whole
        assert row.whole.count("<|im_end|>") == len(want) == row.whole.count("<|im_start|>")
    digest = chat.digests(chat.formatted(spark.createDataFrame(turns, SCHEMA))).where("conv_id = 0").first()
    loss = "".join(t for _, _, r, t in turns[: len(ODD)] if r == "assistant")
    assert digest.loss_chars == len(loss) and digest.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize(
    ("roles", "valid", "complete"),
    [
        ("user assistant", True, True), ("system user", True, False), ("assistant user", False, False),
        ("user user assistant", False, False), ("user assistant tool assistant", True, True),
        ("user assistant system", False, False), ("user other assistant", False, False),
    ],
)
def test_turn_order(spark, roles, valid, complete):
    rows = [(5, i, r, "t") for i, r in enumerate(roles.split())]
    row = chat.formatted(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row.valid, row.complete) == (valid, complete)


def test_edge_rows(spark):
    rows = [
        (None, None, None, None), (None, 2, "user", "b"), (1, 1, "user", "x" * 200_000), (1, 1, "user", "a"),
        (1, 1, "user", "a"), (2, 0, "assistant", None),
    ]
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("segments", F.lit(1)).withColumn("valid", F.lit("x"))
    got = {r.conv_id: r for r in chat.digests(chat.formatted(turns)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {None: 2, 1: 3, 2: 1}
    text = "user\na\nuser\na\nuser\n" + "x" * 200_000 + "\n"
    assert got[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256(b"\n\nuser\nb\n").hexdigest()
    assert got[2].loss_chars == 0 and got[2].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert chat.formatted(turns.limit(0)).count() == 0
