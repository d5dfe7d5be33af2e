import random

import pytest

from postlens.llm import wrappers as W

ARTICLE = [
    ("<h1>Top &amp; title</h1><p>One <b>t</b>wo<br>three&nbsp;&#8364;<p>Four", "Top & title One two three € Four"),
    ("<h2>A</h2><p>b</p><h2>C</h2><p>d</p><h2>E</h2><p>f</p><ul><li>x<li>y</ul>", "A b C d E f x y"),
    ("<p>x</p><aside>no</aside><div class='ad-box'>no</div><form>no<input></form><p>1 &lt; 2 < 3</p>", "x 1 < 2 < 3"),
    ("<p>q<!-- no --></p><script>no</script><section id=comments><p>no</p></section><div class=related><p>no</p></div>", "q"),
    ("<table><tr><td>a<td>b<tr><td>c</table><p>tail", "a b c tail"),
    ("<p hidden>no</p><p style='display: none'>no</p>plain<div>deep <i>er</i></div>", "plain deep er"),
]


def frame(body, kind, number):
    top = f"<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style></head><body class=page><header><h2>site</h2></header><nav><ul><li>m{number}</ul></nav>"
    foot = f"<div class='cookie-notice'>no</div><footer>foot {number}</footer>"
    if kind == "article":
        return f"{top}<main><article>{body}</article><aside>side {number}</aside></main>{foot}"
    if kind == "cut":
        return f"{top}<article>{body}</article>{foot}"[: -len("</footer>")]
    if kind == "main":
        return f"{top}<div role=main>{body}</div><div class=sidebar>side {number}</div>{foot}</body></html>"
    return f"{top}<div class=story>{body}</div><div class=box>Always the same.</div>{foot}</body></html>"


@pytest.mark.parametrize("kind", ["article", "cut", "main", "plain"])
def test_main_text_of_each_template(spark, kind, monkeypatch):
    monkeypatch.setattr(W, "SALTS", 2)
    rows, want = [], {}
    rng = random.Random(kind)
    for i in range(60):
        body, text = ARTICLE[i % len(ARTICLE)]
        words = " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=20))
        rows.append((i, f"http://{'big' if i % 3 else 'Small'}.example.com:80/{i}", frame(f"{body}<p>{words}</p>", kind, i), "t"))
        want[i] = f"{text} {words}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(5)
    assert {r.page_id: r.text for r in W.extract(df).collect()} == want
    hosts = W.infer_wrappers(df).collect()
    assert sorted((r.host, r.pages) for r in hosts) == [("big.example.com", 40), ("small.example.com", 20)]


def test_wrapper_is_a_union_free_expression():
    pages = ["<ul><li>a<li>b</ul><h2>x</h2><p>y</p><h2>x</h2><p>y</p>", "<ul><li>a</ul><hr><h3>s</h3><h2>x</h2><p>z</p>"]
    one, two = map(W.page_wrapper, pages)
    assert W.expression(one) == "<ul>(<li>#</>)+</>(<h2>#</><p>#</>)+"
    both = W.merge(one, two)
    assert W.expression(both).startswith("<ul>(<li>#</>)+</>") and "(<h3>#</>)?" in W.expression(both)
    assert both["/p"][2] is None and W.merge(one, one)["/p"][2] is not None
    assert W.expression(W.merge(both, one)) == W.expression(both)


def test_odd_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    rows = [(1, None, None), (2, "not a url", "<article>x</article>"), (3, "http://h/", ""), (3, "http://h/", "")]
    rows += [(4, "http://l/", long), (None, "http://l/", "<article><p>n</p></article>"), (5, "http://s/", "<p>only <a href='>'>text</a> <unclosed")]
    rows += [(6, "http://t/", "no tags at all &amp; more")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.text) for r in W.extract(df).collect()))
    assert got == [
        (0, "n"), (1, ""), (2, "x"), (3, ""), (3, ""), (4, " ".join(["word & word"] * 30_000)), (5, "only text"),
        (6, "no tags at all & more"),
    ]
    assert W.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("url", ["http://mixed.example.com/{}", None])
def test_templates_of_one_host(spark, url, monkeypatch):
    monkeypatch.setattr(W, "SALTS", 2)
    rows, want = [], {}
    rng = random.Random(5)
    for i in range(60):
        kind = ["article", "main", "plain", "report", "article"][i % 5]
        body, text = ARTICLE[i % len(ARTICLE)]
        words = " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=20))
        page = frame(f"{body}<p>{words}</p>", kind, i)
        if kind == "report" or i == 57:
            page = page.replace("class=story", "class=report" if i != 57 else "class=single")
        rows.append((i, url and url.format(i), page))
        want[i] = f"{text} {words}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = W.extract(df).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(rows)


def test_wrapper_is_as_large_as_the_template(spark):
    def page(i):
        word = "".join(chr(97 + i // 26**k % 26) for k in range(3))
        body = f"<h2 id=my-{word}>Title {word}</h2><p id=p{word}>Text {word}</p><div id='slug-{word}'><p>more {word}</p></div>"
        return (i, "http://hot.example.com/", frame(body, "plain", 0)), f"Title {word} Text {word} more {word}"

    sizes = set()
    for count in (20, 300):
        rows, want = zip(*map(page, range(count)), strict=True)
        df = spark.createDataFrame(list(rows), "page_id long, url string, html string").repartition(4)
        sizes.add(len(W.infer_wrappers(df).first().expression))
        assert {r.page_id: r.text for r in W.extract(df).collect()} == dict(enumerate(want))
    assert len(sizes) == 1
    classes = [W.page_wrapper(f"<div class=post-{'x' * i}>t</div>") for i in range(1, 3 * W.CHILDREN)]
    whole = classes[0]
    for one in classes[1:]:
        whole = W.merge(whole, one)
    assert len(whole[""][3]) <= W.CHILDREN + 1 and whole[""][0] == len(classes)


OTHERS = [
    ("<body class='has-sidebar search-enabled'><div class=story><p>a {0}</p></div><footer>no</footer>", "a {0}"),
    ("<body hidden><main class=with-menu><p>a {0}</p></main><nav>no</nav>", "a {0}"),
    ("<article class='post category-legal'><h2 id='related-work' >a</h2><section id=search><p>{0}</p></section></article><p>no {0}", "a {0}"),
    ("<article><p>a<span class=ad>no <b>no</b><span>no</span> no</span>b <i hidden>no</i>{0}<a class=share>no</p><p>c</article>", "ab {0} c"),
    ("<article><p>a <span class=ad>no <em>no</em></span>{0}</p><section id=comments>no</section></article>", "a {0}"),
    ("<article class=comment><p>no {0}</p></article><main><p>a {0}</p></main>", "a {0}"),
    ("<div class='layout with-sidebar'><div class=story><p>a {0}</p><p>b</p></div></div>", "a {0} b"),
    ("<h2 id=main-results>r {0}</h2><p>a {0} {0}</p><div id='cookie-notice'>no</div>", "r {0} a {0} {0}"),
]


def test_only_what_is_no_article_is_left_out(spark):
    rows, want = [], {}
    for n, (page, text) in enumerate(OTHERS):
        for i in range(4):
            rows.append((4 * n + i, f"http://h{n}.example.com/{i}", page.format(f"word{i}")))
            want[4 * n + i] = text.format(f"word{i}")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in W.extract(df).collect()} == want
