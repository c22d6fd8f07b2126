"""Each stage of the pipeline, run on what the stage before it kept, against a brute-force version."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from lakeshift.llm.common import staged
from tests.llm import cases
from tests.llm.test_models import base_slowly
from tests.llm.test_near import components, group_of_near_copies
from tests.llm.test_quality import brute as quality_slowly
from tests.llm.test_tokens import BYTE, one_at_a_time

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents() -> list[tuple]:
    passage = cases.prose(70, 60)
    pairs = [r for r in cases.rows() if r[0] is not None] + group_of_near_copies(30)
    pairs += [(5000 + k, f"{cases.prose(100 + k, 70)} {passage} {cases.prose(200 + k, 30)}") for k in range(6)]
    pairs += [(6000 + k, f"{cases.prose(300 + k, 80)} a{k}.b@host.example.org or +1 (446) 555-89{k}2, card 4111 1111 1111 1111, ip 10.0.0.{k}") for k in range(6)]
    return [(i, t, "en", None, None if t is None else len(t)) for i, t in pairs]


def cut_slowly(pairs: list[tuple]) -> dict:
    first: dict[bytes, int] = {}
    for i, t in pairs:
        b = t.encode()
        for j in range(len(b) - 49):
            first[b[j : j + 50]] = min(first.get(b[j : j + 50], i), i)
    out = {}
    for i, t in pairs:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 49):
            if first[b[j : j + 50]] < i:
                gone[j : j + 50] = True
        out[i] = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    return out


def masked_slowly(text: str) -> str:
    out, at = "", 0
    for kind, a, b in base_slowly(text):
        if a >= at:
            out += text[at:a] + f"[{kind.upper()}]"
        at = max(at, b)
    return out + text[at:]


def test_stages_equal_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "repeated_passages", "personal_data", "packing"]
    docs = spark.createDataFrame(documents(), SCHEMA).repartition(3)
    rows = {(i, t) for i, t, *_ in documents()}

    def run(name, docs):
        out = staged(stages[name](spark, docs, ""), f"test-{name}")
        if name != "packing":
            assert out.schema == docs.schema
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        return out, [(r["doc_id"], r["text"]) for r in out.collect()] if name != "packing" else None

    docs, got = run("quality_rules", docs)
    assert set(got) == {(i, t) for i, t in rows if quality_slowly(t)[-1]}
    before = sorted(set(got))
    docs, got = run("near_duplicates", docs)
    least = components(before, 5, 80)
    assert sorted(got) == [(i, t) for i, t in before if least[i] == i]
    before = sorted(got)
    docs, got = run("repeated_passages", docs)
    assert dict(got) == cut_slowly(before)
    assert sum(len(t) for _, t in got) < sum(len(t) for _, t in before)
    before = sorted(got)
    docs, got = run("personal_data", docs)
    assert dict(got) == {i: masked_slowly(t) for i, t in before}
    assert "[EMAIL]" in dict(got)[6001]
    packed = run("packing", docs)[0].collect()
    library = Tokenizer.from_file(BYTE)
    lengths = []
    for _, t in got:
        n = len(library.encode(t, add_special_tokens=False).ids) + 1
        lengths += [(n - 1) % 2048 + 1] + [2048] * ((n - 1) // 2048)
    assert sorted(r["length"] for r in packed) == sorted(lengths)
    assert len({r["sequence_id"] for r in packed}) == len(one_at_a_time(lengths, 2048))


def test_run_writes_and_rereads_each_stage(spark, workdir):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{workdir}/documents.parquet")
    out = corpus_pipeline.run(spark, workdir)
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


def test_no_documents(spark, workdir):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{workdir}/documents.parquet")
    assert corpus_pipeline.run(spark, workdir).collect() == []
