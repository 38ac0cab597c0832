"""Conversation repair against a search over whole audits."""

import random

from tests.llm import brute_more
from wattline.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def check(spark, rows, extra=()):
    frame = turn_repair.damaged(spark.createDataFrame(rows, SCHEMA).selectExpr("*", *extra))
    got = {r[0]: tuple(r)[1:] for r in turn_repair.repair(frame).collect()}
    assert got == brute_more.repairs(rows)


def test_given_conversations(spark, given):
    rows = [tuple(r) for r in given("conversations").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_random_conversations(spark, documents):
    rng = random.Random(6)
    texts = ["ok.", "ok. ", "no end", "", " \t", "a?", "b!\n", "same.", "same.", "...", None, "é"]
    roles = ["user", "assistant", "system", "tool", "unknown", "", None, "system"]
    rows = []
    for conv in [*range(250), None]:
        for k in range(rng.randint(1, 9)):
            turn = rng.choice([k, k, k, k + 3, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rows += rows[:40]
    check(spark, rows, ["'k' as fault", "1 as plan", "'x' as said", "true as present"])


def test_a_conversation_of_many_turns(spark, documents):
    rng = random.Random(2)
    rows = [(7, k, rng.choice(["user", "assistant", "tool"]), rng.choice(["yes.", "no", f"turn {k}."])) for k in range(3000)]
    rows += [(8, k, r, t) for _, k, r, t in rows[1500:]]
    check(spark, rows)


def test_endings_are_shared():
    endings = turn_repair.Endings()
    first = endings.move_to("auaus"[::1])
    kept = endings.nodes[:4]
    endings.move_to("auaSU")
    assert [a is b for a, b in zip(endings.nodes, kept)] == [True] * 4
    fresh = turn_repair.Endings()
    assert fresh.move_to("auaus") == first == 0 and fresh.audit() == "KKKKK"


def test_nothing(spark, documents):
    assert turn_repair.repair(turn_repair.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
