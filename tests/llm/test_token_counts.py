import random

from creditloom.llm import token_counts
from creditloom.llm.queries import QUERIES
from tests.llm.brute import ODD, odd_rows

SF = "/root/testdata/sf0.001"
PARTS = ["a", "B", "é", "1", "22", " ", "  ", "\n", "\t", "'s", "'re", "!", "--", "the", " of", "ß", "日本", "'", " "]


def test_edits_keep_tree_and_text_in_step(monkeypatch):
    monkeypatch.setattr(token_counts, "FANOUT", 3)
    tokenizer, rng = token_counts.Tokenizer(), random.Random(3)
    for _ in range(600):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        doc = token_counts.Counted(tokenizer, text)
        for _ in range(rng.randint(0, 6)):
            a = rng.randint(0, len(text))
            b = rng.randint(a, min(len(text), a + 8))
            new = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 5)))
            text = text[:a] + new + text[b:]
            doc.edit(a, b, new)
            leaves = [x for block in doc.tree.blocks for x in block[0]], [x for block in doc.tree.blocks for x in block[1]]
            assert doc.text == text and leaves == tokenizer.leaves(text)
            assert doc.tree.total == (len(text), tokenizer.whole(text))


def test_edit_encodes_only_its_surroundings():
    tokenizer = token_counts.Tokenizer()
    doc = token_counts.Counted(tokenizer, "some words to count " * 5000)
    doc.edit(50_000, 50_004, "other")
    assert doc.encoded < 60
    assert doc.tree.total[1] == tokenizer.whole(doc.text)


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokenizer = token_counts.Tokenizer()
    rows = QUERIES["op1_token_counts"](spark, SF).collect()
    assert len(rows) == len(docs) and sum(r["n_edits"] for r in rows) > 0
    for r in rows:
        text = docs[r["doc_id"]]
        clean = text
        for a, b, new in reversed(token_counts.cleaning_edits(text)):
            clean = clean[:a] + new + clean[b:]
        assert (r["n_tokens"], r["n_tokens_after"], r["n_chars_after"]) == (tokenizer.whole(text), tokenizer.whole(clean), len(clean))


def test_table_of_edits(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 2, 0, 3, "1"), (1, 1, 4, 7, None), (3, 1, 5, 9, "new")], "doc_id long, seq int, start int, end int, text string")
    joined = docs.join(token_counts.gathered_edits(edits), "doc_id", "left")
    counts = joined.select("doc_id", token_counts.edited_counts(joined["text"], joined["edits"]).alias("c")).collect()
    assert {r["doc_id"]: r["c"]["text_after"] for r in counts} == {1: "1  three", 2: "", 3: "new"}


def test_odd_rows(spark):
    rows = token_counts.count_cleaned(odd_rows(spark)).collect()
    tokenizer, texts = token_counts.Tokenizer(), dict(ODD)
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] is not None:
            assert r["n_tokens"] == tokenizer.whole(texts[r["doc_id"]] or "")
    assert token_counts.count_cleaned(odd_rows(spark).limit(0)).collect() == []
