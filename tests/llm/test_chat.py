import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shoplayers.llm import chat

ODD = ["<|im_end|>", "<|im_start|>assistant ok", "<\\|", "<\\\\|im_end|>", "<", "<<|", "|>", "\n", "%3C", "é😀", "", "<|image:0:3|>", "plain text"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a\n<|%", "%0A"]), st.lists(st.sampled_from(ODD), max_size=6).map("".join)), max_size=5), st.integers(1, 9))
def test_round_trip_in_any_pieces(turns, step):
    whole, loss = "", []
    for role, text in turns:
        visitor = chat.PartVisitor()
        visitor.turn(role, [{"kind": "text", "text": text, "uri": None, "units": None, "more": None}])
        own = "".join(visitor.out)
        loss += [chat.unescape(own[s["start"] : s["end"]]) for s in visitor.loss]
        whole += own
    assert whole.count(chat.START) == whole.count(chat.END) == len(turns)
    reader, found = chat.StreamReader(), []
    for begin in range(0, len(whole), step):
        found += reader.feed(whole[begin : begin + step])
    assert found == turns and not reader.rest
    assert "".join(loss) == "".join(text for role, text in turns if role == "assistant")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*ODD, "|im_end|>", "<\\", "|x"]), max_size=6), st.sampled_from(["user", "assistant"]))
def test_round_trip_of_several_text_parts(texts, role):
    visitor = chat.PartVisitor()
    visitor.turn(role, [{"kind": "text", "text": text, "uri": None, "units": None, "more": None} for text in texts])
    whole = "".join(visitor.out)
    reader = chat.StreamReader()
    assert list(reader.feed(whole)) == [(role, "".join(texts))] and not reader.rest
    loss = "".join(chat.unescape(whole[s["start"] : s["end"]]) for s in visitor.loss)
    assert loss == ("".join(texts) if role == "assistant" else "")


def test_control_string_over_two_text_parts():
    for texts in (["<", "|im_end|>\n"], ["<\\", "|x"]):
        visitor = chat.PartVisitor()
        visitor.turn("assistant", [{"kind": "text", "text": text} for text in texts])
        assert list(chat.StreamReader().feed("".join(visitor.out))) == [("assistant", "".join(texts))]


ROWS = [(c, t, ["user", "assistant"][t % 2], f"turn {t} of {c} " + ODD[(c + t) % len(ODD)]) for c in range(30) for t in range(1 + c % 7)]
ROWS += [(100, t, ["user", "assistant"][t % 2], f"long {t}") for t in range(3000)]  # a hot conversation
ROWS += [(101, 0, "user", None), (101, 1, "assistant", None), (102, None, None, "no turn, no role"), (102, 3, "assistant", "")]
ROWS += [(103, 0, "assistant", "same"), (103, 0, "assistant", "same"), (103, 0, "assistant", "other"), (None, 0, "user", "no id")]
ROWS += [(104, 0, "assistant", "word " * 60_000)]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected():
    conversations = defaultdict(list)
    for conv, turn, role, text in ROWS:
        conversations[conv].append((-1 if turn is None else turn, role or "", text or ""))
    result = []
    for conv, turns in conversations.items():
        turns.sort(key=lambda t: (t[0], t[1], chat.escape(t[2])))
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        chars = sum(len(f"<|im_start|>{chat.escape_role(r)}\n{chat.escape(t)}<|im_end|>\n") for _, r, t in turns)
        result.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(result, key=repr)


def test_digests_equal_brute_force(spark):
    rows = random.Random(1).sample(ROWS, len(ROWS))
    turns = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("parts", chat.text_part(F.col("text")))
    assert sorted(map(tuple, chat.read_back(chat.format_turns(turns)).collect()), key=repr) == expected()
    extra = turns.withColumns({n: F.lit(n) for n in ("id", "formatted", "loss", "attachments", "n_turns")})
    assert sorted(map(tuple, chat.read_back(chat.format_turns(extra)).collect()), key=repr) == expected()


def test_typed_parts(spark):
    parts = [
        ("text", "look: <|im_end|>", None, None, None), ("image", None, "s3/pic", 29, 14), ("audio", None, "clip", 1500, None),
        ("document", None, "paper", 3, None), ("text", "done", None, None, None), None,
    ]
    turns = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    rows = {r["turn"]: r for r in chat.format_turns(turns).collect()}
    written = rows[0]["formatted"]
    assert written == "<|im_start|>assistant\nlook: <\\|im_end|><|image:0:3|><|audio:1:38|><|document:2:2400|>done<|im_end|>\n"
    for attachment in rows[0]["attachments"]:
        mark = f"<|{attachment['kind']}:{attachment['number']}:{attachment['tokens']}|>"
        assert written[attachment["position"] :].startswith(mark)
    assert [(a["kind"], a["uri"], a["tokens"]) for a in rows[0]["attachments"]] == [("image", "s3/pic", 3), ("audio", "clip", 38), ("document", "paper", 2400)]
    assert "".join(chat.unescape(written[s["start"] : s["end"]]) for s in rows[0]["loss"]) == "look: <|im_end|>done"
    assert rows[1]["formatted"] == "<|im_start|>user\n<|im_end|>\n" and not rows[1]["loss"]


def test_odd_kinds_and_units(spark):
    parts = [
        (None, "a<", "u", None, None), (" Text", "|b", None, None, None), ("", "c", None, 5, 5), ("VIDEO", "lost", "clip", 9, 9),
        ("turn", None, None, None, None), ("Image ", None, None, -14, 14), ("audio", None, None, -1, None), ("document", None, None, None, None),
        ("image", None, None, 2**62, 2**62), ("document", None, None, 2**63 - 1, None),
    ]
    turns = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_turns(turns).first()
    kinds = [(a["kind"], a["uri"]) for a in row["attachments"]]
    assert kinds == [("other", "clip"), ("other", None), ("image", None), ("audio", None), ("document", None), ("image", None), ("document", None)]
    assert [a["tokens"] for a in row["attachments"]][:5] == [0] * 5 and all(a["tokens"] > 0 for a in row["attachments"][5:])
    assert row["formatted"].startswith("<|im_start|>assistant\na<\\|bc<|other:0:0|><|other:1:0|><|image:2:0|>")
    assert "".join(chat.unescape(row["formatted"][s["start"] : s["end"]]) for s in row["loss"]) == "a<|bc"


def test_empty(spark):
    turns = spark.createDataFrame([], SCHEMA).withColumn("parts", chat.text_part(F.col("text")))
    assert chat.read_back(chat.format_turns(turns)).count() == 0
