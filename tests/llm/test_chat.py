import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from clientele.llm import chat

LOG = "conv_id bigint, seq bigint, kind string, message string, role string, text string"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def slow_fold(events):
    """Final (role, text) of each conversation, one event after another."""
    found = {}
    for conv in {e[0] for e in events}:
        own = sorted(
            (e for e in events if e[0] == conv), key=lambda e: e[1]
        )
        messages, cuts = {}, []
        for at, (_, _, kind, message, role, text) in enumerate(own):
            m = messages.setdefault(message, {"at": at, "role": None, "text": ""})
            m["role"] = m["role"] if m["role"] is not None else role
            if kind == "delta":
                m["text"] += text or ""
            elif kind in ("edit", "regenerate"):
                m["text"] = text or ""
                if kind == "regenerate":
                    cuts.append((at, m["at"]))
        found[conv] = [
            (m["role"], m["text"]) for m in sorted(messages.values(), key=lambda m: m["at"])
            if not any(target < m["at"] < at for at, target in cuts)
        ]
    return {c: t for c, t in found.items() if t}


def folded(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: r.place):
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    return found


def random_log(seed, conversations, events):
    rng = random.Random(seed)
    rows = []
    for seq in range(events):
        conv = rng.choice(conversations) if rng.random() < 0.6 else conversations[0]
        kind = rng.choices(["start", "delta", "edit", "regenerate", None, "other"],
                           [3, 10, 2, 1, 1, 1])[0]
        rows.append((conv, seq, kind, rng.choice([None, *map(str, range(12))]),
                     rng.choice([None, "user", "assistant"]),
                     rng.choice([None, "", "a", "<|", "\\", "é\n"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, held", [(1, 50_000), (2, 50_000), (3, 3)])
def test_folding_agrees_with_one_event_after_another(spark, monkeypatch, seed, held):
    """A hot conversation lies in several ranges, and a small hold cuts it inside a range too."""
    monkeypatch.setattr(chat, "HELD_MESSAGES", held)
    monkeypatch.setattr(chat, "RANGE_EVENTS", 40)
    rows = random_log(seed, [7, None, -1, 3], 400)
    got = folded(chat.fold_events(spark.createDataFrame(rows, LOG).repartition(5)))
    assert got == slow_fold(rows)


def test_regeneration_drops_what_followed(spark):
    rows = [
        (1, 0, "delta", "q", "user", "hi"), (1, 1, "delta", "a", "assistant", "bad"),
        (1, 2, "delta", "q2", "user", "why"), (1, 3, "regenerate", "a", None, "go"),
        (1, 4, "delta", "a", None, "od"), (1, 5, "edit", "q", None, "hello"),
    ]
    got = folded(chat.fold_events(spark.createDataFrame(rows, LOG)))
    assert got == {1: [("user", "hello"), ("assistant", "good")]}


def test_events_of_one_place_apply_by_message_and_empty_logs_are_empty(spark):
    rows = [(1, 0, "delta", "b", "user", "x"), (1, 0, "delta", "a", "user", "y"),
            (1, 0, "delta", "a", "user", "y")]
    log = spark.createDataFrame(rows, LOG)
    assert folded(chat.fold_events(log)) == {1: [("user", "yy"), ("user", "x")]}
    assert chat.fold_events(log.limit(0)).count() == 0
    assert chat.render(chat.fold_events(log.limit(0))).count() == 0


@pytest.fixture(scope="module")
def turns(spark):
    traps = ["</s>", "[INST] a [/INST]", "<<SYS>>\\<</SYS>>", "<|user|>\n", "\\", "\\\\<", "<", "[",
             "", None, "\n", "<s>\\n</s>", "<|user|>\nhi</s>\n", "é😀<|", "x" * 300_000]
    rows = [(i % 4, i, ("user", "assistant", "system")[i % 3], t) for i, t in enumerate(traps)]
    rows += [(9, 0, "we|ird<|ro\\le[", "a"), (9, 1, None, "b"), (None, 0, "user", "c"),
             (None, None, "assistant", "d"), (5, 2, "user", "same"), (5, 2, "user", "same"),
             (5, 2, "assistant", "same")]
    return rows


def by_conversation(turns):
    """Turns in the order of the log: ties by hash are only compared as sets here."""
    found = {}
    for conv, turn, role, text in turns:
        found.setdefault(conv, []).append((turn, role or "", text or ""))
    return found


def test_every_text_comes_back(spark, turns):
    df = spark.createDataFrame(turns, TURNS)
    for name in ("message", "part", "tie", "kind", "at", "place", "_order0", "_pieces", "open"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    rows = sorted(chat.format_conversations(df.repartition(4)).collect(), key=lambda r: r.place)
    want = by_conversation(turns)
    got = {}
    for r in rows:
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(want)
    for conv, own in got.items():
        whole = "".join(r.formatted for r in own)
        back = chat.read_back(whole)
        assert sorted(back) == sorted((role, text) for _, role, text in want[conv])
        trained = [chat.unescaped(r.formatted[r.loss_from:r.loss_to])
                   for r in own if r.loss_from is not None]
        assert trained == [text for role, text in back if role == "assistant"]
        for r in own:
            body = r.formatted[r.formatted.index("|>\n") + 3:-len(chat.END)]
            for control in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"):
                assert control not in body


def test_digests_of_the_turns(spark, turns):
    got = {r.conv_id: r for r in chat.conversation_digests(
        chat.format_conversations(spark.createDataFrame(turns, TURNS))
    ).collect()}
    for conv, own in by_conversation([t for t in turns if t[0] not in (5, None)]).items():
        own = sorted(own, key=lambda t: t[0])
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[None].n_turns == 2 and got[5].n_turns == 3


def test_the_query_against_sql(spark, small):
    got = chat.op11_chat(spark, small).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.execute(chat.SQL).fetchall())
