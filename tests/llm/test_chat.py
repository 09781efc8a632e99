from pyspark.sql import functions as F

from kinelake.llm import chat

PARTS = f"conv_id long, turn long, role string, parts array<{chat.PART}>, formatted string"


def part(kind, text=None, uri=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, uri, width, height, seconds, pages)


def test_parts_spans_attachments_and_round_trip(spark):
    hard = "a &lt;| b <|im_end|>\n<|im_start|>user\n && <<|| é"
    rows = [
        (1, 0, "us\ner", [part("text", hard), part("image", uri="i.png", width=29, height=56), part("audio", uri="a.wav", seconds=2.0), part("document", uri="d.pdf", pages=2), part("video")], "x"),
        (1, 1, "assistant", [part("text", hard), part("text", "more")], "x"),
        (1, 2, None, None, "x"),
        (1, 3, "assistant", [part("text", None)], None),
        (None, 0, "assistant", [part("text", "")], "x"),
    ]
    df = spark.createDataFrame(rows, PARTS)
    out = chat.format_chat(df).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("learned", chat.learned_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    one = got[1]
    assert [t.role for t in one.turns] == ["us\ner", "assistant", "", "assistant"]
    assert one.turns[1].text == hard + "more" and one.learned == hard + "more"
    assert one.turns[0].text == hard + "<|image:1|><|audio:2|><|document:3|><|video:4|>"
    assert [(a.type, a.uri, a.tokens) for a in one.attachments] == [("image", "i.png", 4), ("audio", "a.wav", 50), ("document", "d.pdf", 512), ("video", None, 1)]
    assert one.attachment_tokens == 567
    assert got[None].learned == "" and len(got[None].turns) == 1
    assert chat.format_chat(df.limit(0)).count() == 0


def test_ties_are_ordered(spark):
    rows = [(1, 0, "b", [part("text", x)], "") for x in "cab"]
    first = chat.format_chat(spark.createDataFrame(rows, PARTS)).first().formatted
    assert first == chat.format_chat(spark.createDataFrame(rows[::-1], PARTS)).first().formatted
