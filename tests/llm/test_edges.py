"""Nulls, empty and repeated rows, empty tables and clashing names."""

import pytest

import corpus_pipeline
from cohortrail.llm import bpe, chat, html_text, language, pii, queries, repeats, simhash, token_counts

TEXT = "Mr. John Smith met Mrs. Anna Smith. Mail john.s@example.org, call +1 (017) 555-7713 from 10.0.0.1."


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{i % 977} other{i % 13}" for i in range(20_000))
    rows = [(1, TEXT, "en", "a", 5), (1, TEXT, "en", "a", 5), (2, TEXT, "en", None, None), (3, None, None, None, None),
            (4, "", "en", "", 0), (None, TEXT, None, "b", 1), (None, None, None, None, None), (7, long, "en", "a", 9),
            (8, "!!! 123", "fr", "a", 1), (9, "le chat et la souris dans la maison", "fr", "a", 1)]
    named = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(rows, named).selectExpr("*", "'kept' AS ids", "'k' AS h", "1 AS found", "2 AS score")


def test_digests_have_a_row_for_each_row(docs):
    for result in (bpe.digests(docs), token_counts.over_limit(docs), repeats.digests(docs), simhash.near_duplicates(docs),
                   language.identify(docs)):
        assert result.count() == docs.count()
        assert result.sparkSession is not None


def test_empty_tables(docs, spark):
    none = docs.where("false")
    for result in (bpe.digests(none), token_counts.over_limit(none), repeats.digests(none), simhash.near_duplicates(none),
                   language.identify(none), pii.replace(none), simhash.one_per_group(none), language.accepted(none)):
        assert result.count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_text.main_text(pages).count() == 0
    turns = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert chat.digests(chat.formatted(turns)).count() == 0


def test_repeated_and_null_ids(docs):
    rows = repeats.digests(docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_removed == 0 and by_id[2].n_removed == len(TEXT.encode()) and by_id[None] is not None
    assert sorted(r.n_removed for r in rows if r.doc_id is None) == [0, len(TEXT.encode())]
    groups = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {c for d, _, c in groups if d in (1, 2)} == {1}
    assert {c for d, f, c in groups if f == "0" * 16} == {3}


def test_tokens_of_repeated_rows(docs):
    counted = [r for r in token_counts.over_limit(docs).collect() if r.doc_id == 1]
    assert len(counted) == 2 and counted[0] == counted[1] and counted[0].n_tokens > 10


def test_language_edges(docs):
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs).collect()}
    assert {(3, "und"), (4, "und"), (8, "und"), (None, "und")} <= got
    assert language.accepted(docs).columns == docs.columns


def test_surrogates(docs, spark):
    out = pii.replace(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    new = {r.text for r in out.where("doc_id IN (1, 2) OR doc_id IS NULL AND text IS NOT NULL").collect()}
    assert len(new) == 1
    text = new.pop()
    for part in ("John", "Anna", "Smith", "john.s@example.org", "(017)", "10.0.0.1"):
        assert part not in text
    words = text.split()
    assert words[0] == "Mr." and words[4] == "Mrs." and words[2] == words[6].rstrip(".")
    assert words[1] in pii.GIVEN["m", "latin"] and words[5] in pii.GIVEN["f", "latin"]
    rest = {r.doc_id: r.text for r in out.collect()}
    assert rest[8] == "!!! 123" and rest[4] == "" and rest[3] is None


def test_surrogates_are_distinct_and_keep_their_format(spark):
    rows = [(i, f"{i % 10}.{i // 10 % 10}.{i // 100}.7") for i in range(900)]
    rows += [(1000, "4111 1111 1111 1111"), (1001, "4111111111111111"), (1002, "4111111111111112"), (1003, "Господин Иван Петров")]
    found = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    hosts = [found[i] for i in range(900)]
    assert len(set(hosts)) == 900 and not set(hosts) & {t for _, t in rows}
    assert found[1000].replace(" ", "") == found[1001] and found[1000][4] == " " and found[1001] != rows[-3][1]
    assert found[1002] == "4111111111111112"
    assert found[1003].split()[1] in pii.GIVEN["m", "cyrillic"]


def test_another_key_gives_other_surrogates(spark):
    frame = spark.createDataFrame([(1, "mail me at someone@example.org")], "doc_id bigint, text string")
    assert pii.replace(frame, "a").first().text != pii.replace(frame, "b").first().text
    assert pii.replace(frame, "a").first().text == pii.replace(frame, "a").first().text


def test_pages_with_odd_rows(spark):
    rows = [(i, f"https://h.example/{i}", f"<body><div>Menu of h</div><p>Text {i}</p></body>") for i in range(9)]
    rows += [(20, None, "<p>a"), (21, "nonsense", "<p>b"), (22, "http://h.example/x", None), (None, "http://h.example/y", "")]
    rows.append(rows[0])
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'c' AS wrapper", "'d' AS text")
    got = sorted((r.page_id or -1, r.text, r.n_chars) for r in html_text.main_text(frame).collect())
    assert len(got) == 14 and (3, "Text 3", 6) in got and (20, "a", 1) in got and (22, "", 0) in got


def test_conversations_with_odd_rows(spark):
    rows = [(1, 0, None, None), (1, None, "user", "a"), (None, 0, "assistant", "b"), (1, 0, None, None)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").selectExpr("*", "1 AS rendered")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(chat.formatted(frame)).collect()}
    assert got == {1: (3, 0), None: (1, 1)}


@pytest.mark.parametrize("name", ["op3_chat", "op4_repeats", "op6_top_k"])
def test_queries_match_their_sql(spark, duck, name):
    from tests.compare import difference, duck_rows, spark_rows

    sf_dir = "/root/testdata/sf0.001"
    columns, got = spark_rows(queries.registered()[name](spark, sf_dir))
    names, want = duck_rows(duck(sf_dir), queries.statements()[name])
    assert columns == names and got == want, difference(got, want)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered()) == list(range(1, 14))


def test_pipeline_stages_take_odd_rows(docs, spark):
    sf_dir = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
    assert corpus_pipeline.encoding(spark, docs, sf_dir).where("NOT round_trip").count() == 0
