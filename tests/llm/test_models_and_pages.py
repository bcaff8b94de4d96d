"""Trained operators by held-out accuracy; pages against their articles; SQL of this package."""

from __future__ import annotations

import html
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphmill.llm import html_extract, quality, toxicity
from graphmill.llm.common import table
from graphmill.llm.ftrl import Ftrl
from graphmill.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, duck

ROWS = [(1, None), (2, ""), (3, "plain words here"), (3, "plain words here"), (None, "x"), (5, "a " * 50000)]


def test_quality_held_out(spark, sf):
    out = QUERIES["op7_quality"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert len(out) > 50 and ((out["score"] >= 0.3) == (out["predicted"] == 1)).all()
    good, bad = out[out["quality"] == 1]["score"], out[out["quality"] == 0]["score"]
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean() > 0.98
    assert (out["predicted"] == out["quality"]).mean() > 0.97


def test_quality_awkward(spark, sf):
    docs = spark.createDataFrame([(i, t, 3) for i, t in ROWS], "doc_id long, text string, predicted int")
    labels = table(spark, sf, "labels")
    out = quality.score(docs, quality.fit(*quality.training_rows(table(spark, sf, "documents"), labels, "quality", 500)), name="p")
    got = out.collect()
    assert len(got) == len(ROWS) and all(0 <= r["p"] <= 1 and r["predicted"] == 3 for r in got)
    none = quality.quality(docs.drop("predicted"), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality(docs.limit(0), labels).count() == 0


def test_toxicity_accuracy(spark, sf):
    scored = QUERIES["op3_toxicity"](spark, sf).withColumnRenamed("toxic", "said")
    out = scored.join(table(spark, sf, "labels"), "doc_id").where(quality.held_out()).toPandas()
    bad, clean = out[out["toxic"] == 1], out[out["toxic"] == 0]  # 45 toxic rows to learn from at this size
    assert (out["said"] == out["toxic"]).mean() > 0.94 and clean["said"].mean() < 0.02
    assert bad["severity"].mean() > 0.8 > 0.2 > clean["severity"].mean()


def test_toxicity_awkward(spark, sf):
    docs = spark.createDataFrame([(i, t, 3) for i, t in ROWS], "doc_id long, text string, grade int")
    labels = table(spark, sf, "labels")
    assert toxicity.severity(docs, labels.limit(0)).agg(F.sum("severity")).first()[0] == 0
    assert toxicity.severity(docs, labels.withColumn("toxic", F.lit(None).cast("int"))).count() == len(ROWS)
    assert toxicity.severity(docs.limit(0), labels).count() == 0


def _article(page: str) -> str:
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br|article)[^>]*>", body))
    return "\n".join(b for b in blocks if b)


def test_pages(spark, sf):
    pages = {r["page_id"]: r["html"] for r in table(spark, sf, "pages").collect()}
    got = QUERIES["op6_html"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == _article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


LONG = "A sentence of some length stands here, with a comma. Another one follows it, and ends. "


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<html><body><nav>menu</nav></body></html>", ""), ("plain  text", "plain text"), ("a &lt;b&gt; &eacute;&#33;&nbsp;x", "a <b> é! x"),
    (f"<body><div class='top-menu'><a>x</a></div><div id=c><h2>T</h2><p>{LONG}</p><p>Ok.</p><ul><li>one<li>two</ul></div>"
     f"<div class='sidebar'><p>{LONG}</p></div><section id='comments'><p>{LONG}{LONG}</p></section></body>", f"T\n{LONG.strip()}\nOk.\none\ntwo"),
    (f"<main><header><h1>T</h1><span>by me</span></header><p>{LONG}<b>bo</b>ld<br>next</p><form><input>sub</form><div role='alert'>{LONG}</div></main>",
     f"T\n{LONG}bold\nnext"),
    (f"<article><p>{LONG}<script>if (a<b) {{ x(\"</p>\") }}</script><!-- c --></p><div class='cookie-notice'>We use cookies, ok.</div></article><footer>f</footer>", LONG.strip()),
    ("<article><p>cut off in the mid", "cut off in the mid"), ("<p a='>'>x</p><p>y", "x\ny"),
])
def test_page_cases(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("name", ["overflow-hidden", "content has-sidebar", "site no-sidebar", "entry no-comments", "widget", "sidebar",
                                  "elementor-widget elementor-widget-theme-post-content"])
@pytest.mark.parametrize("tag", ["div", "article"])
def test_page_wrappers(name, tag):
    """A wrapper's class never takes the article with it."""
    page = f"<body><nav>menu</nav><div class='{name}'><{tag}><h1>T</h1><p>{LONG}</p><p>{LONG}</p></{tag}></div></body>"
    assert html_extract.main_text(page) == f"T\n{LONG.strip()}\n{LONG.strip()}"


def test_page_sections_inside_an_article():
    page = (f"<article><h1>T</h1><p>{LONG}</p><h2 id='search-results'>S</h2><p>{LONG}</p><section id='discussion'><p>{LONG}</p></section>"
            f"<div id='related-work'><p>{LONG}</p></div></article>")
    assert html_extract.main_text(page) == "\n".join(["T", LONG.strip(), "S", LONG.strip(), LONG.strip(), LONG.strip()])


@pytest.mark.parametrize("page, text", [
    (f"<body><h1>T</h1><div class=post>{f'<p>{LONG}</p>' * 12}</div></body>", ["T", *[LONG.strip()] * 12]),
    (f"<body><div class=lead><p>{LONG}</p></div><div class=post>{f'<p>{LONG}</p>' * 12}</div><div class=last><h3>E</h3><p>{LONG}</p></div></body>",
     [LONG.strip()] * 13 + ["E", LONG.strip()]),
    (f"<body><article>{f'<p>{LONG}</p>' * 12}</article><article><h2>U</h2><p>{LONG}</p></article></body>", [LONG.strip()] * 12 + ["U", LONG.strip()]),
])
def test_page_text_beside_the_root(page, text):
    assert html_extract.main_text(page) == "\n".join(text)


def test_page_deep():
    """End tags of elements below the greatest depth close no outer element."""
    page = f"<body><div><article><p>{LONG}</p>{'<div>' * 500}<i>in</i>{'</div>' * 500}<aside>a</aside><p>{LONG}</p></article></div><footer>f</footer></body>"
    assert html_extract.main_text(page) == f"{LONG.strip()}\nin\n{LONG.strip()}"


TEXT = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
READ = f"T\n{LONG.strip()}\n{LONG.strip()}"


@pytest.mark.parametrize("page, text", [
    (f"<body><form id='aspnetForm'><nav><a>m</a></nav><div>{TEXT}</div><footer>f</footer></form></body>", READ),
    (f"<body><div aria-hidden='true'><form><article>{TEXT}</article></form></div></body>", READ),
    (f"<body><header class='wrap'><nav>m</nav><main>{TEXT}</main></header></body>", READ),
    (f"<body><nav><a>one</a> <a>two</a>{TEXT}</body>", READ), (f"<body><header><a>one</a><article>{TEXT}</article></body>", READ),
    (f"<body><svg class='i'/>{TEXT}</body>", READ), (f"<body><p>x <svg><path d='M0'/><text>drawn</text><h1>T</h1><p>{LONG}</p><p>{LONG}</p></body>", "x\n" + READ),
    (f"<article><h1>T</h1><p>{LONG}a<svg><title>i</title><g><text>drawn</text></g></svg>b</p></article>", f"T\n{LONG}ab"),
    (f"<article><header><h1>T</h1><p>Stand, first.</p><span>by me</span></header><p>{LONG}</p></article>", f"T\nStand, first.\n{LONG.strip()}"),
    # no wrappers: the page has its text elsewhere, or none
    (f"<body><article>{TEXT}</article><form><h1>Sign up</h1><p>{LONG}</p></form></body>", READ),
    ("<body><form><label>Search</label><button>Go</button></form></body>", ""), ("<body><nav><a>m</a>", ""),
    (f"<body><nav><p>{LONG}</p><p>{LONG}</p></nav></body>", ""), (f"<article>{TEXT}</article><footer>f, and more", READ),
])
def test_page_wrapped_or_unclosed(page, text):
    assert html_extract.main_text(page) == text


def test_page_names_and_menus_at_any_depth():
    """Below 5,000 elements a menu, a role and a hidden element are still left out, in time that grows with the page."""
    deep = "<div>" * 5000 + f"<nav>m</nav><p hidden>h</p><div role='search'>s</div><p>{LONG}</p>" + "<i></b>" * 20_000 + "</div>" * 5000
    begun = time.time()
    assert html_extract.main_text(f"<body><article><p>{LONG}</p>{deep}</article></body>") == f"{LONG.strip()}\n{LONG.strip()}"
    assert html_extract.main_text("<div class='sidebar'><p>x</p>" * 5000 + f"<article>{TEXT}</article>").endswith(READ)
    assert time.time() - begun < 20


def test_page_rows(spark):
    pages = spark.createDataFrame([(1, None, None, 5), (1, "u", "<p>x", 5), (1, "u", "<p>x", 5)], "page_id long, url string, html string, text int")
    assert sorted(r["n_chars"] for r in html_extract.extract(pages).collect()) == [0, 1, 1]
    assert html_extract.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, sf, name):
    res = compare(QUERIES[name](spark, sf), duck(sf), ORACLE[name])
    assert res["exact"] and res["cols_match"], res


def test_toxicity_statistics(spark, sf):
    """Typical features, sizes and grades against plain counting, in two shards."""
    import numpy as np
    import pyarrow as pa

    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").where("toxic is not null")
    plain = [(r["text"] or "", r["toxic"] > 0) for r in docs.select("text", "toxic").collect()]
    found = list(toxicity._rows(pa.array([t for t, _ in plain])))
    bad, good = Counter(), Counter()
    for own, (_, toxic) in zip(found, plain):
        (bad if toxic else good).update(own.tolist())
    n_bad = sum(t for _, t in plain)
    odds = {i: np.log((n + 0.5) / (n_bad + 1)) - np.log((good[i] + 0.5) / (len(plain) - n_bad + 1)) for i, n in bad.items() if n >= toxicity.MIN_ROWS}
    want = sorted(i for i, o in odds.items() if o * np.sqrt(bad[i]) >= toxicity.MIN_ODDS)
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") > 0).alias("toxic"), F.pmod("doc_id", F.lit(2)).cast("long").alias("shard"))
    ids = toxicity.typical(rows)
    assert want and ids.tolist() == want
    graded = toxicity.grades(toxicity.known_features(rows, ids)).collect()
    known = [len(set(own.tolist()) & set(want)) / max(len(own), 1) for own in found]
    cuts = np.quantile([d for d, (_, t) in zip(known, plain) if t], [1 / 3, 2 / 3])
    assert sorted((r["toxic"], r["size"], len(r["own"]), r["grade"]) for r in graded) == sorted(
        (t, len(own), round(d * len(own)), int(1 + (d > cuts).sum()) if t else 0) for own, d, (_, t) in zip(found, known, plain))


def test_ordinal_steps_follow_the_gradient():
    """Severity grows with the words that only severe rows have; thresholds ascend."""
    import numpy as np

    rows, grade = [], []
    for k in range(400):
        g = k % 4
        rows.append(np.array([j for j in range(4) if j <= g]))
        grade.append(g)
    w, theta = toxicity.train(rows, np.array(grade), 4)
    assert (np.diff(theta) > 0).all()
    said = [int((w[r].sum() > theta).sum()) for r in rows[:4]]
    assert said == [0, 1, 2, 3]


def test_ftrl_equals_plain_updates():
    """The vector form equals the per-coordinate rule written out."""
    import numpy as np

    rng = np.random.default_rng(3)
    model, z, n = Ftrl(6, alpha=0.5, beta=1.0, l1=0.1, l2=0.2), [0.0] * 6, [0.0] * 6

    def plain(i):
        if abs(z[i]) <= 0.1:
            return 0.0
        return -(z[i] - (0.1 if z[i] > 0 else -0.1)) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.2)

    for _ in range(50):
        i = np.sort(rng.choice(6, 3, replace=False))
        g, w = rng.normal(size=3), model.weights(i)
        assert np.allclose(w, [plain(j) for j in i])
        model.update(i, g, w)
        for j, d, u in zip(i, g, w):
            z[j] += d - ((n[j] + d * d) ** 0.5 - n[j] ** 0.5) / 0.5 * u
            n[j] += d * d
    assert np.allclose(model.weights(), [plain(j) for j in range(6)])


def test_quality_scores_are_plain_dot_products(spark, sf):
    """Each score equals a sum over the text's own features, text by text."""
    import numpy as np
    import pyarrow as pa

    docs = table(spark, sf, "documents")
    weights = quality.fit(*quality.training_rows(docs, table(spark, sf, "labels"), "quality", 400))
    got = quality.score(docs.select("doc_id", "text"), weights).collect()
    for r in got[::5]:
        i, x = next(quality._scaled(pa.array([r["text"] or ""]), quality.BITS))
        assert abs(r["score"] - 1 / (1 + np.exp(-(sum(weights[a] * b for a, b in zip(i, x)) + weights[-1])))) < 1e-9
