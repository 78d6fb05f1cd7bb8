import hashlib
import random

import pyarrow as pa

from texloom.llm import chat

TRAP = "\\### Assistant: </turn> ok"


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_random_turns_come_back():
    rnd = random.Random(1)
    piece = lambda: "".join(rnd.choice(["#", "##", "###", "\\", "</turn>", "</turn", ">", "<", ":", " ", "\n", "é", "𝄞", "a"]) for _ in range(rnd.randint(0, 9)))
    turns = [(piece(), piece()) for _ in range(3000)]
    made, starts, stops = chat.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    texts = made.to_pylist()
    assert [chat.parse(x) for x in texts] == [[t] for t in turns]
    assert chat.parse("".join(texts)) == turns
    assert [chat.unescaped(x.encode()[a:b].decode()) for x, a, b in zip(texts, starts, stops, strict=True)] == [t for _, t in turns]
    sliced = pa.array(["zz", *[t for _, t in turns[:9]]]).slice(1)
    assert chat.assemble(pa.array([r for r, _ in turns[:9]]), sliced)[0].to_pylist() == texts[:9]


def test_conversations(spark, monkeypatch):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "user", None), (2, 0, None, ""), (2, None, "x", TRAP), (-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP), (None, 0, "user", "n"), (3, 0, "assistant", "y"), (3, 0, "assistant", "x"), (3, 0, "assistant", "x"), (4, 0, "assistant", "é" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as part", "2 as loss")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_chats(chat.format_chats(df)).collect()}
    want = {c: digests([(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]) for c in {r[0] for r in rows}}
    assert got == want
    assert chat.read_chats(chat.format_chats(df.where("false"))).count() == 0


def test_long_conversations_come_in_parts(spark):
    df = spark.range(300).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('word ', 20000) as text")
    made = chat.format_chats(df)
    assert made.count() > 2 and not made.where("whole").count()
    many = spark.range(4000).selectExpr("id div 2 as conv_id", "id % 2 as turn", "'user' as role", "cast(id as string) as text")
    assert chat.format_chats(many).where("whole").count() > 1900
    assert {tuple(r)[1:3] for r in chat.read_chats(chat.format_chats(many)).collect()} == {digests([("user", str(2 * i)), ("user", str(2 * i + 1))])[:2] for i in range(2000)}
    (row,) = chat.read_chats(made).collect()
    assert tuple(row)[1:5] == digests([("user" if i % 2 == 0 else "assistant", "word " * 20000) for i in range(300)])
