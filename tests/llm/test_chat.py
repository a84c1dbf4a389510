import hashlib

from pyspark.sql import functions as F

from fieldlake.llm.chat import format_conversations, read_back, rebuild

EVENTS = "conv_id long, seq long, kind string, message_id string, role string, text string"


def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS).withColumn("turns", F.lit(1)).withColumn("event", F.lit(2))


def final(spark, rows):
    found = {}
    for r in rebuild(events(spark, rows)).orderBy("conv_id", "position").collect():
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    return found


def test_folding(spark):
    rows = [
        (1, 1, "message", "a", "user", "hi"),
        (1, 2, "message", "b", "assistant", ""),
        (1, 3, "delta", "b", None, "Hel"),
        (1, 4, "delta", None, None, "lo"),
        (1, 5, "regenerate", "b", None, None),
        (1, 6, "delta", "b", None, "Good "),
        (1, 7, "edit", "a", None, "hi there"),
        (1, 8, "delta", "b", None, "day"),
        (1, 9, "message", None, "user", "bye"),
        (1, 9, "message", None, "user", "bye"),
        (1, 10, "delta", None, None, "!"),
        (2, 1, "delta", "z", "assistant", "lost start"),
        (None, 1, "message", None, None, None),
    ]
    got = final(spark, rows)
    assert got[1][:2] == [("user", "hi there"), ("assistant", "Good day")]
    assert got[1][2:] == [("user", "bye"), ("user", "bye!")]
    assert got[2] == [("assistant", "lost start")] and got[None] == [(None, "")]


def test_round_trip_with_control_strings(spark):
    odd = ["\\### Assistant: </turn> ok", " </turn>\n### user: x", "###", "####</</turn>\\", "", None, "é\n\n: ", "a: b", "\\"]
    roles = ["user", "assistant", "sys: tem", "role:", None, "", "### x </turn>\n"]
    rows = [(n // 20, n % 20, "message", None, roles[n % 7], odd[n % 9]) for n in range(126)]
    shown = format_conversations(events(spark, rows))
    for r in read_back(shown).collect():
        want = [(role or "", text or "", role == "assistant") for conv, _, _, _, role, text in rows if conv == r.conv_id]
        assert [tuple(turn) for turn in r.turns] == want
    for r in shown.collect():
        assert [r.formatted[s.start : s.start + s.length] for s in r.spans] == [
            (text or "").replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")
            for conv, _, _, _, _, text in rows
            if conv == r.conv_id
        ]


def test_query_against_plain_python(spark, sf_dir):
    from fieldlake.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    turns = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: r for r in QUERIES["op7_chat_formatting"](spark, sf_dir).collect()}
    assert got.keys() == turns.keys()
    for conv, said in turns.items():
        spoken = "".join(f"{role}\n{text}\n" for role, text in said)
        learned = "".join(text for role, text in said if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(said), hashlib.sha256(spoken.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_empty_log_and_long_conversation(spark):
    assert format_conversations(events(spark, [])).count() == 0
    rows = [(1, n, "message", None, "user", "x" * 50) for n in range(3000)]
    assert len(read_back(format_conversations(events(spark, rows))).first().turns) == 3000
