"""Whole small tables: held-out accuracy, and the pipeline against a brute-force version."""

import re

import numpy as np
import pytest
import public_tokenizers
import tiktoken

import corpus_pipeline
from cohortrail.llm import bpe, html_text, language, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang_pred == r.lang for r in found)
    assert len(found) > 150 and right >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_main_texts_are_the_articles(spark):
    import html

    def article(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
        return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = html_text.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    assert len(found) == len(pages) and all(r.text == article(pages[r.page_id]) for r in found)


def test_pipeline_by_brute_force(spark, given):
    benchmark = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # Language: every given document is in one of the four languages.
    ids = sorted(given)
    prints = {i: simhash.fingerprint(given[i].text) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    left = [i for i in ids if find(i) == i]
    plain = {i: " ".join(re.findall(r"[^\W_]+", given[i].text.lower())) for i in left}
    left = {i for i in left if not any(b in plain[i] for b in benchmark)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == left and len(rows) == len(left)
    library = tiktoken.Encoding(
        "x", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANKS)),
    )
    private = re.compile(r"[\w.]+@[\w.]+\.com|\+\d \(\d{3}\) \d{3}-\d{4}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)")
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text) and r.round_trip
        before, after = private.findall(given[r.doc_id].text), private.findall(r.text)
        assert len(before) == len(after) and not set(before) & set(after)
        if not before and not re.search(r"\d{16}", r.text):
            assert r.text == given[r.doc_id].text
