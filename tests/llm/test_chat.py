import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from starbrook.llm import chat

SF = "/root/testdata/sf0.001"
COLUMNS = "conv_id bigint, turn bigint, role string, text string, part int, ids string"
ODD = [
    (1, None, None, None), (1, 1, "assistant", None), (1, 2, "assistant", "  \n\\<|x|> <\\| é😀 \n"),
    (1, 2, "user", "<|im_sep|>"), (1, 3, "assistant", "\n"), (1, 3, "assistant", "\n"),
    (None, 1, "a<|im_end|>b", "x"), (2, 1, "assistant", "y" * 3000), (2, 2, "assistant", " z\\"),
    (2, 3, "assistant", chat.CONTROL_TEXT), (3, 0, "user", "<|endoftext|>"),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    turns = defaultdict(list)
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        turns[conv].append((role or "", text or ""))
    return {
        conv: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), sum(len(x) for r, x in t if r == "assistant"),
               sha("".join(x for r, x in t if r == "assistant")))
        for conv, t in turns.items()
    }


def digests(df):
    found = df.collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:5] for r in found}


def test_query(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    rows += [(-1, 0, "user", chat.CONTROL_TEXT), (-1, 1, "assistant", chat.CONTROL_TEXT)]
    found = chat.op7_chat_formatting(spark, SF)
    assert digests(found) == brute(rows)
    assert found.filter("conv_id = -1").first().formatted_chars == len(
        chat.render([("user", chat.CONTROL_TEXT), ("assistant", chat.CONTROL_TEXT)]).text
    )


def test_odd_rows(spark):
    turns = spark.createDataFrame([(*r, 7, "x") for r in ODD], COLUMNS)
    assert digests(chat.chat_digests(turns)) == brute(ODD)
    assert chat.chat_digests(turns.limit(0)).collect() == []
    whole = chat.chat_digests(turns).collect()
    parted = chat.chat_digests(turns, part_chars=5)  # parts change nothing
    assert sorted(whole, key=str) == sorted(parted.collect(), key=str)


def test_masks(spark):
    turns = spark.createDataFrame([(*r, 7, "x") for r in ODD], COLUMNS)
    own = chat.tokenizer(open(chat.public_tokenizers.path(chat.VOCABULARY), encoding="utf-8").read())
    for r in chat.format_chats(turns).collect():
        assert len(r.ids) == len(r.loss_mask)
        written = own.decode([i for i, m in zip(r.ids, r.loss_mask, strict=True) if m], skip_special_tokens=False)
        learned = [chat.escape(text) for role, text in chat.read_back(r.text) if role == "assistant"]
        assert written == "".join(learned)


def test_a_hot_conversation_is_split(spark):
    # a third of all rows in one conversation; others before, between and after
    rows = [(5, i, ("user", "assistant")[i % 2], f"{i} <|im_end|> é" + "x" * (i % 50)) for i in range(900)]
    rows += [(c, t, ("user", "assistant")[t], f"{c}.{t}") for c in range(100, 1000) for t in (0, 1)]
    rows += [(None, None, "assistant", f"none {i}") for i in range(300)]
    turns = spark.createDataFrame([(*r, 7, "x") for r in rows], COLUMNS).repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = chat._ordered(turns).withColumn("task", F.spark_partition_id())
        tasks = tasks.groupBy("conv_id").agg(F.countDistinct("task").alias("n"))
        split = {r.conv_id: r.n for r in tasks.collect()}
        assert split[5] > 1 and split[None] >= 1
        assert digests(chat.chat_digests(turns, part_chars=2000)) == brute(rows)
        parts = chat.format_chats(turns, part_chars=2000).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = defaultdict(list)
    for r in sorted(parts, key=lambda r: r.part):
        assert r.part == len(found[r.conv_id])  # gapless, in order
        found[r.conv_id].append(r)
    assert len(found[5]) > 5
    own = chat.tokenizer(open(chat.public_tokenizers.path(chat.VOCABULARY), encoding="utf-8").read())
    for conv, (n, turns_sha, _, _) in brute(rows).items():
        text = "".join(r.text for r in found[conv])
        read = chat.read_back(text)
        assert (len(read), sha("".join(f"{role}\n{x}\n" for role, x in read))) == (n, turns_sha)
        if conv == 5:  # the ids are those of the whole
            assert [i for r in found[conv] for i in r.ids] == own.encode(text, add_special_tokens=False).ids


def test_escapes_are_reversible():
    for text in ("", "\\", "<|", "\\<|", "<\\|", "<<||", chat.CONTROL_TEXT, "\\\\<\\\\|"):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
