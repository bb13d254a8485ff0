"""Per-text operators against the libraries themselves, round trips and brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

from cohortrail.llm import bpe, chat, html_text, simhash, token_counts

POOL = list("abcXYZ 's't'll  \n\t\r\x1c\x1f ²½ªµéÉÇñİΣσς中文字かなא١٢͸՘\U00011de0😀é_-!?.,123") + [
    "<|endoftext|>", "<|startoftext|>", "<|", "</s>", "[INST]",
]


def texts(n, seed=1):
    random.seed(seed)
    out = ["", "a" * 3000, " " * 500, "ab" * 4000]
    out += ["".join(random.choice(POOL) for _ in range(random.randrange(60))) for _ in range(n)]
    wide = lambda: chr(random.choice([random.randrange(0xD800), random.randrange(0x10000, 0x20000), 32, 97]))
    return out + ["".join(wide() for _ in range(30)) for _ in range(n // 4)]


def test_ids_are_those_of_the_library():
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = bpe.serialise(ranks)
    encoder, pieces = bpe.Encoder(model, public_tokenizers.PATTERN), bpe.piece_bytes(model)
    given = texts(3000)
    for text, ids in zip(given, encoder.encode(given), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text[:50])
        assert bpe.joined(ids, pieces) == text.encode()


def test_few_remembered_pre_tokens_change_nothing(monkeypatch):
    model = bpe.serialise(bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))
    given = texts(300)
    want = bpe.Encoder(model, public_tokenizers.PATTERN).encode(given)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    small = bpe.Encoder(model, public_tokenizers.PATTERN)
    assert [small.encode([t])[0] for t in given] == want


def test_pieces_add_up_to_the_librarys_tokens():
    path = public_tokenizers.path(token_counts.TOKENIZER)
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        tokens = token_counts.Tokens(file.read())
    # Every code point below U+0180, alone, inside a word, and in random mixtures.
    low = [chr(c) for c in range(0x180)]
    random.seed(3)
    mixed = ["".join(random.choices(low + POOL, k=40)) for _ in range(2000)]
    for text in texts(3000, 2) + low + [f"ab{c}cd {c}" for c in low] + mixed:
        found = Counter(p for w in tokens.words(text) for p in tokens.of(w))
        assert sum(tokens.pieces(p) * n for p, n in found.items()) == len(library.encode(text, add_special_tokens=False).ids)


def test_turns_are_read_back_and_control_strings_escaped():
    random.seed(2)
    pool = [*chat.RESERVED, "\\", "<", "|", ">", "[", "]", "/", "s", "\n", "a", "<\\|im_end|>", "<\\\\s>"]
    for _ in range(5000):
        text, role = ("".join(random.choice(pool) for _ in range(random.randrange(n))) for n in (12, 4))
        rendered = chat.render(role, text)
        assert [t[:2] for t in chat.parse(rendered)] == [(role, text)]
        body = rendered[len(chat.OPEN) : -len(chat.CLOSE) - 1]
        assert not any(r in body for r in chat.RESERVED)
    assert chat.render("user", "plain") == f"{chat.OPEN}user\nplain{chat.CLOSE}\n"


def test_fingerprints_by_brute_force():
    def brute(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        if not words:
            return 0
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for text in [*texts(500, 3), "a", "a b", "A B C", "É é b c", " \n "]:
        assert simhash.fingerprint(text) == brute(text)
    assert simhash.fingerprint(None) == 0


PAGE = """<html><head><title>T</title></head><body class="with-sidebar"><div class=cookie-notice>We use cookies</div>
<header><h1>Site</h1></header><ul class=menu><li><a href=/>Home</a><li><a href=/b>B</a></ul><div id="content">
<h1>Big &amp; news</h1><p>One <b>two</b> &lt;x&gt; &nbsp; four<br>five<p>six</p><form><button>Go</button></form>
<ul><li>x<li>y</ul></div><aside>side</aside><div class=comments><p>first!</p></div><script>var t="</p>";</script></body>"""


def test_main_text_of_a_page():
    assert html_text.extract(PAGE, None) == "Big & news\nOne two <x> four five\nsix\nx\ny"
    assert html_text.extract("<div>" * 5000 + "deep", None) == "deep"
    assert html_text.extract(None, None) == "" == html_text.extract("<script>x</script>", None)
    assert html_text.extract("a < b & c <p", None) == "a < b & c <p"


def test_what_all_pages_of_a_host_hold_is_template():
    pages = [f"<body><div>Same line</div><div>Text {i}</div><div><span>Fixed</span> end</div></body>" for i in range(5)]
    wrapper = html_text._restore(html_text.json.loads(html_text.induce(pages[:4])))
    assert html_text.extract(pages[4], wrapper) == "Text 4"
    # A page that would be template throughout keeps its text.
    assert html_text.extract("<body><div>Same line</div></body>", wrapper) == "Same line"
    assert html_text.induce(pages[:2]) == ""


def test_tree_match_finds_the_largest():
    a, b = (html_text.parse(p) for p in ("<ul><li>1<li>2<li>3</ul>", "<ul><li>0<li>2<li>3<li>4</ul>"))
    pairs = html_text.match(a, b)[1]
    assert {(x.text(), y.text()) for x, y in pairs if x.tag == "li"} >= {("2", "2"), ("3", "3")}


def test_digest_columns(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    given = {r.doc_id: r.text for r in docs.collect()}
    for row in bpe.digests(docs).collect():
        ids = library.encode_ordinary(given[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(given[row.doc_id].encode()).hexdigest()
