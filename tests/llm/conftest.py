import os
import tempfile

import pytest


@pytest.fixture(scope="session", autouse=True)
def _importable():
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def tables(spark):
    """Small tables with nulls, repeats, ties, a long text and columns with clashing names."""
    import random

    random.seed(3)
    words = [f"w{k}" for k in range(400)]
    sentence = lambda n: " ".join(random.choice(words) for _ in range(n))
    base = sentence(120)
    near = base.split()
    near[60] = "changed"
    passage = "\n".join(sentence(30) for _ in range(12))
    texts = [
        base,
        base,
        " ".join(near),
        None,
        "",
        " ",
        "one",
        "One",
        "two words",
        passage,
        sentence(20) + "\n" + passage + "\n" + sentence(25),
        sentence(40) + "\n" + passage,
        "é" * 400 + " x",
        "é" * 400 + " x",
        sentence(30_000),
        "naïve   text <|endoftext|> with  <|im_end|> marks",
        "\n".join(["same line of words here"] * 40),
        *(sentence(random.randint(5, 90)) for _ in range(60)),
    ]
    rows = [(k, t, random.choice(["en", "de", None, "xx"]), f"s{k % 3}", len(t or ""), k, "x") for k, t in enumerate(texts)]
    rows += [rows[0], rows[20], (None, base, None, None, None, None, None), (None, None, None, None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, rid bigint, kept string"
    docs = spark.createDataFrame(rows, schema).repartition(5)
    folder = tempfile.mkdtemp(prefix="llm-tables-")
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    items = [(1, base[:200]), (2, sentence(40)), (2, sentence(40)), (3, None), (4, "short"), (None, base[100:260])]
    spark.createDataFrame(items, "item_id bigint, text string").write.mode("overwrite").parquet(
        f"{folder}/benchmark.parquet"
    )
    turns = [
        (1, 0, "user", "hello"),
        (1, 1, "assistant", "a <|im_end|> b <\\|x"),
        (2, 1, "assistant", None),
        (2, 0, None, "x\n"),
        (2, 1, "assistant", "tie"),
        (2, 1, "assistant", "tie"),
        (None, 0, "user\nrole<|n|>", "<|im_start|>user\n"),
        (3, None, "assistant", "<" * 5 + "|"),
    ]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.mode(
        "overwrite"
    ).parquet(f"{folder}/conversations.parquet")
    vectors = [(k, [float(k % 5), 1.0, -0.5], k % 3) for k in range(300)] + [(None, None, None)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").write.mode(
        "overwrite"
    ).parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_tables(spark, tables):
    folder = tempfile.mkdtemp(prefix="llm-empty-")
    for name in ("documents", "benchmark", "conversations", "embeddings"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.mode("overwrite").parquet(
            f"{folder}/{name}.parquet"
        )
    return folder


@pytest.fixture(scope="session")
def rows(spark, tables):
    found = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in found]
