"""Deep pages, and what the pages of a host share."""

import random

import pytest

from cohortrail.llm import html_text


def test_deep_elements_close_themselves():
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    page = f"<body><div id=page><article><p>before</p>{deep}<p>behind</p></article></div><div>no article</div></body>"
    assert html_text.extract(page, None) == "before\ndeep\nbehind"
    hidden = "<nav><div>" * 400 + "menu" + "</div></nav>" * 400
    page = f"<body><article><p>a</p>{'<div>' * 400}<nav><p>no</p><ul><li>no</ul></nav>{'</div>' * 400}{hidden}<p>b</p></article></body>"
    assert html_text.extract(page, None) == "a\nb"
    nested = "<main>" * 500 + "<p>x</p>" + "</main>" * 500
    assert html_text.extract(f"<body>{nested}<p>y</p></body>", None) == "x"


def test_every_distinct_page_of_a_host_counts(spark):
    """Hosts of two pages, of many copies of one page, and templates that some pages lack or that lie in long lists."""

    def page(own, notice="Fixed notice"):
        return f"<body><div>{notice}</div><p>{own}</p></body>"

    rows = [(i, "http://two/", page(f"two {i}")) for i in range(2)]
    rows += [(10 + i, "http://copied/", page("copy")) for i in range(300)]
    rows += [(1000 + i, "http://copied/", page(f"copied {i}")) for i in range(2)]
    rows += [(2000 + i, "http://some/", page(f"some {i}", "Fixed notice" if i % 4 else f"other {i}")) for i in range(40)]
    for i in range(3):  # an early child whose equal stands near the end of the others
        items = [f"<p>{i}-{k}</p>" for k in range(600 + 50 * i)]
        early = ["<b>mark</b>"]
        items = early + items if i == 0 else items + early
        rows.append((3000 + i, "http://long/", f"<body>{''.join(items)}<div><i>{i}</i><em>Line of all</em></div></body>"))
    rows.append((4000, "http://deep/", "<div>" * 3000 + "deep"))
    rows.append((4001, "http://deep/", "<div>" * 3000 + "down"))
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in html_text.main_text(frame).collect()}
    assert len(found) == len(rows)
    assert all(found[i] == f"two {i}" for i in range(2)) and found[10] == "copy" and found[1001] == "copied 1"
    assert all(found[2000 + i] == ("" if i % 4 else f"other {i}\n") + f"some {i}" for i in range(40))
    assert not any("Line of all" in found[3000 + i] for i in range(3)) and found[4001] == "down"


def plain_match(a, b):
    """The size of the largest match of two trees, by the textbook."""
    if a.key != b.key:
        return 0
    xs, ys = a.nodes(), b.nodes()
    sizes = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            found = plain_match(x, y)
            sizes[i + 1][j + 1] = max(sizes[i][j + 1], sizes[i + 1][j], sizes[i][j] + found if found else 0)
    return 1 + (a.text() == b.text()) + sizes[-1][-1]


def random_page(rnd, most=12):
    parts = "".join(
        rnd.choice(("<p>{}</p>", "<div>{}<b>{}</b></div>", "<ul><li>{}</li><li>{}</li></ul>", "<div><p>{}</p>", "</div>")).format(
            *(rnd.choice("abc") for _ in range(2))
        )
        for _ in range(rnd.randrange(most))
    )
    return f"<body>{parts}</body>"


@pytest.mark.parametrize("cells", [4, 1 << 20])
def test_match_is_the_largest(cells, monkeypatch):
    monkeypatch.setattr(html_text, "CELLS", cells)
    rnd = random.Random(cells)
    for _ in range(300):
        a, b = (html_text.parse(random_page(rnd)) for _ in range(2))
        size, pairs = html_text.match(a, b)
        assert size == plain_match(a, b) == sum(1 + (x.text() == y.text()) for x, y in pairs)
        of = dict(pairs)
        assert len(of) == len(pairs) == len(set(of.values())) and all(x.key == y.key for x, y in pairs)
        for x, y in pairs:  # children of pairs are in pairs of children, in order
            at = [y.nodes().index(of[n]) for n in x.nodes() if n in of]
            assert at == sorted(at)


def test_wrappers_are_aligned(spark):
    """Texts that pages hold in another order, or more often, match the template once; the rest is content."""
    rows = [(i, "http://order/", f"<body><p>alpha</p><p>beta</p><b>own {i}</b></body>") for i in range(5)]
    rows += [(i, "http://order/", f"<body><p>beta</p><p>alpha</p><b>own {i}</b></body>") for i in range(5, 7)]
    rows += [(10 + i, "http://often/", f"<body>{'<p>Yes</p>' * (1 if i < 5 else 3)}<b>own {i}</b></body>") for i in range(6)]
    rows += [
        (20 + i, "http://parts/", f"<body>{'<p>A</p>' * (i < 8)}{'<div>B</div>' * (i > 3)}<b>own {i}</b></body>")
        for i in range(12)
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in html_text.main_text(frame).collect()}
    assert all(found[i] == f"own {i}" for i in range(5)) and all(found[10 + i] == f"own {i}" for i in range(5))
    assert all(found[i] in (f"alpha\nown {i}", f"beta\nown {i}") for i in range(5, 7))
    assert found[15] == "Yes\nYes\nown 5"
    assert all(found[20 + i] == f"own {i}" for i in range(12))


def test_wrappers_are_those_of_each_host_alone(spark):
    rnd = random.Random(1)
    hosts = {f"h{k}": [random_page(rnd) for _ in range(rnd.randrange(3, 12))] for k in range(12)}
    rows = [(0, f"http://{h}/{i}", page) for h, pages in hosts.items() for i, page in enumerate(pages * 2)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.host: [bytes(t).hex() for t in r.wrapper] for r in html_text.wrappers(frame).collect()}
    alone = {h: html_text.induce(pages) for h, pages in hosts.items() if len(set(pages)) >= html_text.AGREEING}
    assert sum(map(bool, alone.values())) > 3
    for h, wrapper in alone.items():
        assert found.get(h, []) == (html_text.json.loads(wrapper) if wrapper else [])
