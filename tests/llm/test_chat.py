import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delayhouse.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place string, piece string, span string, rows string"
ODD = [
    "", None, "plain", "</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s>[\\INST]", "<|im_end|>", "<|im_start|>user<|im_sep|>x<|im_end|>", "<", "<|im_end|", "<|im_sep|>",
    "a\nb\n", "\\", "<<|im_end|>>", "[[INST]]", "<\\<|im_end|>", "é\U0001f600 <s>", " x " * 5000,
]


def rows():
    out = [(i // 3, i % 3, ("user", "assistant", None)[i % 3], t) for i, t in enumerate(ODD)]
    out += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, None, "system", "first"), (50, 2, "assistant", "b"), (50, 2, "assistant", "b")]
    return out + [(None, 0, "ro<|im_sep|>le", "x"), (None, 1, "assistant", "y"), (51, 0, "assistant\n", "no")]


def expected():
    talks = {}
    for conv, turn, role, text in rows():
        talks.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    for conv, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        yield str(conv), len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def conversations(spark):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows()], SCHEMA).repartition(3)


def test_odd_turns_read_back(spark):
    formatted = chat.format_conversations(conversations(spark))
    got = chat.digests(formatted).collect()
    assert sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == sorted(expected())
    assert chat.format_conversations(conversations(spark).limit(0)).collect() == []


def test_the_loss_mask_covers_the_trained_texts(spark):
    for row in chat.format_conversations(conversations(spark)).collect():
        covered = [row.formatted[s.start : s.start + s.length] for s in row.loss_spans]
        trained = [t.text for t in row.turns if t.role == "assistant"]
        frame = spark.createDataFrame(list(enumerate(covered)), "i int, t string").select("i", chat.unescape(F.col("t")).alias("t")) if covered else None
        assert ([r.t for r in frame.orderBy("i").collect()] if frame else []) == trained


def test_the_digests_come_from_the_mask(spark):
    """A wrong mask changes what is read back."""
    formatted = chat.format_conversations(conversations(spark))
    right = {str(r.conv_id): r.loss_sha256 for r in chat.digests(formatted).collect()}
    moved = F.transform("loss_spans", lambda s: F.struct((s["start"] - 1).alias("start"), s["length"].alias("length")))
    wrong = {str(r.conv_id): r.loss_sha256 for r in chat.digests(formatted.withColumn("loss_spans", moved)).collect()}
    trained = {str(r.conv_id) for r in formatted.filter(F.exists("turns", lambda t: (t["role"] == "assistant") & (t["text"] != ""))).collect()}
    assert trained and all(right[c] != wrong[c] for c in trained)


def test_no_control_string_stays_in_a_text(spark):
    for row in chat.format_conversations(conversations(spark)).collect():
        inside = row.formatted
        for mark in (chat.START, chat.SEPARATOR, chat.END):
            assert inside.count(mark) == row.n_turns
        assert not any(c in inside for c in chat.CONTROL[3:])


def test_the_parser_rejects_what_is_no_turn(spark):
    texts = ["x", chat.START + "a", chat.START + "a" + chat.END, "junk" + chat.END, f"{chat.START}a{chat.SEPARATOR}b</s>{chat.END}"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(chat.parse(F.col("t")).alias("p"))
    assert all(None in r.p for r in frame.collect())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.lists(st.sampled_from(["<", "|im_end|>", "/s>", "\\", "[", "INST]", "a", "<s>"]), max_size=8).map("".join)), min_size=1, max_size=40))
def test_any_text_reads_back(spark, turns):
    frame = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(frame).first()
    assert [(t.role, t.text) for t in row.turns] == turns
