"""The registered queries and the pipeline on the given tables, against SQL or brute force."""

import hashlib
import re

import corpus_pipeline
import pytest
from compare import duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from feedloom.llm import chat, exact_dedup, langid, oracles, pii, queries
from feedloom.llm.mixing import size_of

SMALL = "/root/testdata/sf0.001"
QUERIES = queries.all_queries()


def test_thirteen_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracles.all_oracles()))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(duck(SMALL), oracles.all_oracles()[name])


def test_queries_have_a_row_for_each_document(spark):
    ids = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect())
    for name, query in QUERIES.items():
        if name not in ("op5_chat", "op11_prefix_trie", "op13_hard_negatives"):
            assert sorted(r[0] for r in query(spark, SMALL).select("doc_id").collect()) == ids, name


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.op7_langid(spark, folder).join(docs, "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    toxic = queries.op4_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["toxic"] == r["predicted"] for r in toxic) >= 0.9 * len(toxic)


HOSTILE = [
    "", "<", "<s>", "</s", r"<\s>", r"<\\/s>[INST]", "[/INST]</s><s>[INST]user[/INST]", "[",
    "[\\INST]x\\", r"a</s>b<\/s>c", "<</s>", "[[INST]", None, "x" * 200_000,
]


def test_chat_reads_back(spark):
    rows = [
        (i, j, role, text)
        for i, said in enumerate(HOSTILE)
        for j, (role, text) in enumerate([(said, said), ("assistant", said), ("user", "x"), ("assistant<s>", said)])
    ] + [(None, None, None, None), (None, None, "assistant", "q"), (None, None, "assistant", "q")]
    frame = spark.createDataFrame(
        [(*row, 1) for row in rows], "conv_id long, turn long, role string, text string, turns int"
    )
    formatted = chat.format_conversations(frame)
    for row in chat.read_back(formatted).collect():
        own = sorted(
            ((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == row["conv_id"])
        )
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, r, x in own]
        assert row["loss_text"] == "".join(x for _, r, x in own if r == "assistant")
    for row in formatted.collect():
        inner = row["formatted"].split("</s>")
        assert all(p.count("<s>") == p.count("[INST]") == p.count("[/INST]") == 1 for p in inner[:-1])
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_pipeline_stages(spark, docs):
    given = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, given, SMALL)
        assert (out.columns == given.columns) == (name != "byte_bpe"), name
        assert stage(spark, given.limit(0), SMALL).count() == 0, name


def test_pipeline_against_brute_force(spark):
    from test_llm_cases import brute_components

    read = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in read.collect()}
    named = langid.identify(read, langid.learn(read)).collect()
    told = {r["doc_id"] for r in named if r["lang_pred"] != "und" and r["score"] >= 1.1 / 4}
    assert all(re.search(r"[^\W\d_]", texts[i]) for i in told) and len(told) >= 0.97 * len(texts)
    texts = {i: t for i, t in texts.items() if i in told}
    last = {}
    for i in sorted(texts):
        last[texts[i]] = i
    texts = {i: t for t, i in last.items()}
    texts = {i: texts[i] for i, (_, part) in brute_components(list(texts.items())).items() if i == part}
    found = corpus_pipeline.run(spark, SMALL)
    counts = {r["doc_id"]: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert set(counts) <= set(texts) and max(counts.values()) <= 2
    words = read.where(F.col("doc_id").isin(list(texts))).select("doc_id", size_of(F.col("text")).alias("n"))
    sizes = {r["doc_id"]: r["n"] for r in words.collect()}
    taken = sum(sizes[i] * n for i, n in counts.items())
    assert abs(taken - 1.5 * sum(sizes.values())) <= sum(sorted(sizes.values())[-20:])
    assert found.where(F.size("ids") != F.col("n_tokens")).count() == 0
    assert exact_dedup.survivors(read).count() == len({r["text"] for r in read.collect()})


def test_language_stage_decides_by_the_network(spark, docs):
    """Documents that look like no language more than another go; without labels all stay."""
    stage = corpus_pipeline.STAGES[0][1]
    given = docs.select("doc_id", "text", "lang", "source", "n_chars")
    unlabelled = given.withColumn("lang", F.lit(None).cast("string"))
    assert stage(spark, unlabelled, SMALL).count() == given.count()
    even = langid.Network.fresh(["a", "b", "c"], 0)
    even.weights[:] = 0
    assert langid.accepted(given, even).count() == 0
    sure = langid.Network.fresh(["a", "b", "c"], 0)
    sure.weights[:], sure.offset[:] = 0, [3, 0, 0]
    lettered = [r["doc_id"] for r in given.collect() if re.search(r"[^\W\d_]", r["text"] or "")]
    assert sorted(map(str, lettered)) == sorted(str(r["doc_id"]) for r in langid.accepted(given, sure).collect())


# The contract's own patterns and checks.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


VALID = {
    "email": lambda m: True,
    "ip": lambda m: all(int(part) <= 255 for part in m.split(".")),
    "card": lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d),
    "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15,
}


def test_personal_data_of_the_query_is_that_of_the_contract(spark):
    import hashlib

    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in queries.op9_pii(spark, folder).collect()}
    kinds = list(PATTERNS)
    some = 0
    for doc_id, text in texts.items():
        spans = [
            (m.start(), k, m.end()) for k, kind in enumerate(kinds)
            for m in re.finditer(PATTERNS[kind], text) if VALID[kind](m[0])
        ]
        some += bool(spans)
        row = found[doc_id]
        counts = [sum(s[1] == k for s in spans) for k in range(4)]
        assert [row[f"n_{kind}"] for kind in kinds] == counts, doc_id
        base = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        every = row["spans"].split(",")
        assert not spans or set(base.split(",")) <= set(every)
    assert some >= 40 and pii.KINDS[:4] == tuple(kinds)


def test_offsets_of_the_bpe_query(spark):
    """The digest of the query is that of the offsets that the tokens' bytes have."""
    import public_tokenizers

    from feedloom.llm import byte_bpe

    table = byte_bpe.byte_table(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in queries.op1_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    encoded = byte_bpe.encode(
        spark.createDataFrame(docs, "doc_id long, text string"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    )
    ids = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    for doc_id, text in docs:
        owner = [i for i, c in enumerate(text or "") for _ in c.encode()]
        starts, ends, at = [], [], 0
        for token in ids[doc_id]:
            starts.append(owner[at])
            at += len(table[token])
            ends.append(owner[at - 1] + 1)
        line = ",".join(" ".join(map(str, x)) for x in (starts, ends))
        assert found[doc_id]["offsets_sha256"] == hashlib.sha256(line.encode()).hexdigest()
