import hashlib

from pyspark.sql import functions as F

from tidemark.llm import chat

ROWS = [(1, 0, "user", "hi <|im_end|> <\\|x|> <\\\\| a<b|c"), (1, 1, "assistant", "<|im_start|>assistant\nno"), (1, 2, None, None), (1, 2, None, None), (2, 0, "assistant", None), (2, 1, "a\nb\\n<|c", "x"),
        (None, 0, "user", "no id"), (3, 5, "assistant", "tie b"), (3, 5, "assistant", "tie a"), (3, 5, "user", "tie a"), (4, None, "assistant", "é\U0001f389" * 3), (5, 0, "system", "long " * 100000), (5, 1, "assistant", "<|" * 5000)]


def expected(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1], x[2] or "", x[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    done = []
    for c, turns in out.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        done.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(done, key=repr)


def test_round_trip(spark):
    src = spark.createDataFrame([(*r, "z", 1) for r in ROWS], "conv_id long, turn long, role string, text string, segment string, head int").repartition(4)
    segments = chat.format_conversations(chat.with_probe(src))
    probe = [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    got = chat.digests(chat.read_turns(segments)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=repr) == expected(ROWS + probe)
    assert {r.segment.count("<|im_start|>") for r in segments.collect()} == {1}
    assert sum(r.formatted_chars for r in got) == sum(len(r.segment) for r in segments.collect())


def test_empty_table(spark):
    src = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.read_turns(chat.format_conversations(src))).collect() == []


def test_typed_parts(spark):
    part = lambda kind, text=None, uri=None, w=None, h=None, s=None, p=None: (kind, text, uri, w, h, s, p)
    rows = [(1, 0, "user", [part("text", "see "), part("image", uri="i.png", w=57, h=28), part("text", "<|image|>"), part("audio", uri="a.wav", s=1.5), part("document", uri="d.pdf", p=2), part("video"), part(None, "t")]),
            (1, 1, "assistant", None), (1, 2, "assistant", [part("text", "ok")])]
    got = chat.format_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")).orderBy("turn").collect()
    assert got[0].segment == "<|im_start|>user\nsee <|image|><\\|image|><|audio|><|document|><|attachment|>t<|im_end|>\n"
    found = [tuple(a) for a in got[0].attachments]
    assert [(k, u, n) for k, u, n, _ in found] == [("image", "i.png", 3), ("audio", "a.wav", 38), ("document", "d.pdf", 2048)]
    assert all(got[0].segment[p:].startswith(f"<|{k}|>") for k, _, _, p in found)
    assert got[0].expanded_tokens == 3 + 38 + 2048 and got[0].loss_start == got[0].loss_stop
    assert got[1].segment == "<|im_start|>assistant\n<|im_end|>\n" and got[1].loss_start == got[1].loss_stop
    assert got[2].segment[got[2].loss_start: got[2].loss_stop] == "ok"


def test_escape_is_reversible(spark):
    texts = ["", "<", "<|", "<\\|", "<\\\\|x", "|<|>", "\\<|\\", "<<||", "a" * 10]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    e = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.unescape_role(chat.escape_role(F.concat(F.lit("\\n\n"), "t"))).alias("r")).collect()
    assert all(x.u == x.t and "<|" not in x.e and x.r == "\\n\n" + x.t for x in e)
