"""Style trees on made pages, and the hidden Markov model against an exhaustive search."""

from __future__ import annotations

import html
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendcast.llm import chat, styletree
from tests.llm.helpers import prose


def texts(page):
    return [b["text"] for b in styletree.parse(page)[0]]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, []),
        ("", []),
        ("plain &amp; <b>simple</b>", ["plain & simple"]),
        ("<p>a<p>b<br>c  \n d</p>e", ["a", "b c d", "e"]),
        ("<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", ["x", "y", "1", "2", "3"]),
        ("<article><h1>T</h1><p>one</p><aside>no</aside><div class='comments'><p>no</p></div></article><p>out</p>", ["T", "one"]),
        ("<main><p>m</p><article><p>a</p></article></main>", ["a"]),
        ("<div role=main><p>m</p></div><p>out</p>", ["m"]),
        ("<header>h</header><nav>n</nav><p>x</p><footer>f</footer><form>g</form>", ["x"]),
        ("<div class='ad top'>a</div><div id=cookie-notice>c</div><div class='content-with-sidebar'>kept</div>", ["kept"]),
        ("<div class='site-header'>h</div><div id=mainNav>n</div><div class='side-bar'>s</div><div class='post-comments'>c</div><p>x", ["x"]),
        ("<body class='has-sidebar ads'><div class='sidebar-layout'><p data-class='ad'>x</p><p aria-hidden=false>y</p></div>", ["x", "y"]),
        ("<p style='color:red'>x</p><p style='display: none'>no</p><p aria-hidden='true'>no</p>", ["x"]),
        ("<article><header><h1>T</h1></header>x</article>", ["T", "x"]),
        ("<script>if (a<b) { '</p>' }</script><style>p{}</style><noscript>n</noscript><p>x", ["x"]),
        ("<!-- <p>no</p> --><p>x<!-- y", ["x"]),
        ("<p hidden>no</p><p>x&nbsp;&#65;&lt;", ["x A<"]),
        ("<p>x<a href='never ends", ["x"]),
        ("a < b and <3 </nothing> </p>", ["a < b and <3"]),
        ("<section class=comments><article>no</article></section><article>yes</article>", ["yes"]),
        ("<p>" + "w " * 100_000 + "</p>", [" ".join(["w"] * 100_000)]),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, ["deep"]),
    ],
)
def test_blocks_of_a_page(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>t</title><meta charset=utf-8><body><p>x</p>", ["x"]),
        ("<head><title>t</title><script>s</script> <p>x", ["x"]),
        ("<head><title>t</title>x<p>y", ["x", "y"]),
        ("<nav>n</nav><div class='elementor-widget'><p>a b c</p></div><div class='elementor-widget'><p>d e f</p></div>", ["a b c", "d e f"]),
        ("<div class='widget'>w</div><p>a b c</p>", ["a b c"]),
        ("<article><p class=teaser>lead</p><div class='teaser'>more</div><p>body</p><div class=related>r</div></article>", ["lead", "more", "body"]),
        ("<div class=search-results><article><p>a b c</p></article></div><p>x</p>", ["a b c"]),
        ("<body><a>skip</a><form id=aspnetForm><nav>a b c d</nav><div><p>x y z</p></div></form>", ["skip", "x y z"]),
        ("<nav>n</nav><div class=comment-box><p>all there is</p></div>", ["all there is"]),
    ],
)
def test_no_name_or_open_head_empties_a_page(page, want):
    assert texts(page) == want


CARDS = "<div>" + "".join(f"<article><p>card {i}</p></article>" for i in range(3)) + "</div>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<main><p>{prose(1, 40)}</p></main>{CARDS}", [prose(1, 40)]),
        (f"<main><p>{prose(1, 40)}</p>{CARDS}</main><p>out</p>", [prose(1, 40), "card 0", "card 1", "card 2"]),
        (f"<div><p>{prose(1, 40)}</p></div>{CARDS}", [prose(1, 40), "card 0", "card 1", "card 2"]),
        (f"<main><h1>T</h1><article><p>{prose(1, 40)}</p></article><p>after</p></main>", ["T", prose(1, 40)]),
        (f"<article><p>{'字' * 50}</p></article><p>{prose(1, 40)}</p>", ["字" * 50]),
        (CARDS, ["card 0", "card 1", "card 2"]),
    ],
)
def test_marked_elements_count_alone_where_they_hold_half_of_the_page(spark, page, want):
    assert texts(page) == want
    df = spark.createDataFrame([(1, "http://a.example/", page)], "page_id long, url string, html string")
    assert styletree.extract_text(df).first()["text"].split("\n") == want


def page(rnd, body, host_line):
    menu = "".join(f"<li><a href='/{i}'>{prose(rnd.randrange(10**6), 1)}</a></li>" for i in range(rnd.randrange(3, 7)))
    return (
        f"<html><head><title>t</title></head><body><div class='top'><ul>{menu}</ul></div><div id='box'><p>{host_line}</p></div>"
        f"<div id='c'>{body}</div><div class='end'><p>{host_line} again</p></div></body>"
    )


def test_repeated_branches_of_a_host_are_removed(spark):
    rnd = random.Random(1)
    rows, want = [], {}
    for i in range(60):
        blocks = [html.escape(prose(i * 10 + j, 12) + " <&>") for j in range(1 + i % 4)]
        host = "big.example" if i % 3 else f"h{i}.example"
        rows.append((i, f"https://{host}/x/{i}", page(rnd, "".join(f"<p>{b}</p>" for b in blocks), "Subscribe to " + host), "clash"))
        want[i] = [html.unescape(b) for b in blocks]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, tree_row string")
    found = {r["page_id"]: r["text"].split("\n") for r in styletree.extract_text(df).collect()}
    for i, blocks in want.items():
        if i % 3:  # the host with many pages: its repeated box and end go, the content stays
            assert [b for b in found[i] if b in blocks] == blocks
            assert not any("Subscribe" in b for b in found[i])
        else:  # a host with one page cannot be judged
            assert any("Subscribe" in b for b in found[i])


def test_removal_without_broadcast_is_the_same(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, "http://a.example/", page(rnd, f"<p>{prose(i, 9)}</p>", "same")) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    first = sorted(styletree.extract_text(df).collect())
    monkeypatch.setattr(styletree, "BROADCAST_ROWS", 0)
    assert sorted(styletree.extract_text(df).collect()) == first


def test_an_article_that_all_pages_share_stays(spark):
    rows = [(i, "http://a.example/", "<nav>n</nav><article><p>same for all</p></article>") for i in range(20)]
    df = spark.createDataFrame([*rows, (20, None, None), (20, None, "<p>x</p>")], "page_id long, url string, html string")
    found = styletree.extract_text(df).collect()
    assert sorted((r["page_id"], r["text"]) for r in found) == sorted([(i, "same for all") for i in range(20)] + [(20, ""), (20, "x")])
    assert styletree.extract_text(df.limit(0)).count() == 0


def test_what_a_host_repeats_inside_its_articles_goes(spark):
    box = "<div class=box><p>follow our channel for more</p></div>"
    rows = [(i, "http://a.example/", f"<{tag}><h1>t{i}</h1>{box}<p>{prose(i, 20)}</p></{end}>")
            for i, (tag, end) in enumerate([("article", "article"), ("main", "main"), ("div role=main", "div"), ("div itemprop=articleBody", "div")] * 6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in styletree.extract_text(df).collect()}
    assert found == {i: f"t{i}\n{prose(i, 20)}" for i in range(24)}


def test_importance_by_hand(spark):
    """Four pages of a host: a box that looks the same and says the same, a list that does neither."""
    rows = [(i, "http://h/", f"<div id=a><p>same</p></div><ul>{'<li>' * i}u{i}</ul>") for i in range(1, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    parsed = [styletree.parse(r["html"]) for r in pages.collect()]
    df = spark.createDataFrame([("h", *p) for p in parsed], "tree_host string, " + styletree.PARSED)
    found = {r["path"]: r["importance"] for r in styletree.importance(df).collect()}
    box = styletree._hash("div#a", 0)
    assert found[box] == pytest.approx(0.0)
    assert found[styletree._hash("p", box)] == pytest.approx(0.0)
    assert found[styletree._hash("ul", 0)] == pytest.approx(1.0)


def model():
    rng = np.random.default_rng(3)

    def logs(*shape):
        t = rng.random(shape) + 0.05
        return np.log(t / t.sum(axis=-1, keepdims=True))

    return chat.ChatModel(logs(6), logs(6, 6), tuple(logs(6, n) for n in chat._VALUES))


def score(m, shows, path):
    total = m.start[path[0]] + shows[0][path[0]]
    for i, (a, b) in enumerate(itertools.pairwise(path)):
        total += m.move[a, b] + shows[i + 1][b]
    return total


def test_blocks_give_the_best_path():
    m, rng = model(), np.random.default_rng(5)
    names = ("marker", "size", "asks", "gap")
    rows = [{n: int(rng.integers(v)) for n, v in zip(names, chat._VALUES)} for _ in range(6)]
    shows = chat._scores(m, rows)
    best = max(itertools.product(range(6), repeat=6), key=lambda p: score(m, shows, p))
    first, second = shows[:2], shows[2:]
    a, b = chat._sum_up(m, first, True), chat._sum_up(m, second, False)
    joined = a[0][:, None] + b
    before, end = np.unravel_index(joined.argmax(), joined.shape)
    path = [*chat._decode(m, first, None, int(before)), *chat._decode(m, second, int(before), int(end))]
    assert joined.max() == pytest.approx(score(m, shows, best))
    assert tuple(path) == best


def conversations(spark, count=120, turns=6):
    rows = []
    for c in range(count):
        for t in range(1 + (c * 7) % turns + 1):
            role = ("user", "assistant")[t % 2]
            text = "\n".join(prose(c * 100 + t * 10 + k, 8 + 20 * (t % 2)) + ("?" if role == "user" else ".") for k in range(1 + t % 3))
            rows.append((c, t, role, text))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def squeeze(text):
    return " ".join((text or "").split())


def test_turns_are_recovered(spark):
    df = conversations(spark)
    held = F.col("conv_id") % 3 == 0
    lines = chat.transcript_lines(df)
    fitted = chat.fit_chat_model(lines.where(~held))
    turns = chat.parse_transcripts(lines.where(held), fitted).collect()
    want = {(r["conv_id"], r["role"], squeeze(r["text"])) for r in df.where(held).collect()}
    got = {(r["conv_id"], r["role"], squeeze(r["text"])) for r in turns}
    assert len(want & got) > 0.9 * len(want) and len(want & got) > 0.9 * len(got)
    for conv in {r["conv_id"] for r in turns}:
        numbers = sorted(r["turn_no"] for r in turns if r["conv_id"] == conv)
        assert numbers == list(range(numbers[0], numbers[0] + len(numbers)))
    # No line is lost or moved.
    for conv in (0, 3, 6):
        own = sorted((r for r in turns if r["conv_id"] == conv), key=lambda r: r["turn_no"])
        assert re.sub(r"\W", "", "".join(r["text"] for r in own)) == re.sub(
            r"\W", "", "".join(r["text"] for r in df.where(F.col("conv_id") == conv).orderBy("turn").collect())
        )


def test_texts_of_turns_are_whole(spark, monkeypatch):
    monkeypatch.setattr(chat, "TURNS_PER_BLOCK", 4)
    rows = []
    for c in range(40):
        for t in range(8):
            answer = f"Note: {prose(c * 50 + t, 30)}.\n\n\n    if x:\n\n        {prose(c, 12)}\n  \n{prose(t, 40)}."
            rows.append((c, t, ("user", "assistant")[t % 2], answer if t % 2 else f"{prose(c * 9 + t, 9)}?"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = chat.transcript_lines(df)
    turns = chat.parse_transcripts(lines, chat.fit_chat_model(lines)).collect()
    want = {(r[0], r[2], r[3]) for r in rows}
    got = {(r["conv_id"], r["role"], r["text"]) for r in turns}
    assert len(want & got) > 0.9 * len(want) and len(want & got) > 0.9 * len(got)
    # With the blank lines inside turns, and with names that are no speakers' where the marker is lost.
    plain = spark.createDataFrame([(1, 0, "user", "Note: a"), (1, 1, "user", "https://x")], "conv_id long, turn long, role string, text string")
    bare = plain.select("conv_id", F.col("turn").alias("part"), F.lit(0).cast("long").alias("tie"), F.lit(0).alias("sub"), F.col("text").alias("line"))
    found = chat.parse_transcripts(bare, chat.fit_chat_model(lines)).collect()
    assert "\n".join(r["text"] for r in sorted(found, key=lambda r: r["turn_no"])) == "Note: a\nhttps://x"
    # Blank lines before any turn make no turn.
    assert chat.parse_transcripts(bare.withColumn("line", F.lit(" ")), chat.fit_chat_model(lines)).count() == 0


def test_a_long_conversation_is_decoded_in_blocks(spark, monkeypatch):
    df = conversations(spark, 1, 2).limit(0)
    rows = [(1, t, ("user", "assistant")[t % 2], prose(t, 10 + 30 * (t % 2)) + ("?" if t % 2 == 0 else "")) for t in range(300)]
    df = spark.createDataFrame(rows, df.schema)
    lines = chat.transcript_lines(df)
    fitted = chat.fit_chat_model(lines)
    blocks = sorted(map(tuple, chat.parse_transcripts(lines, fitted).collect()))
    monkeypatch.setattr(chat, "TURNS_PER_BLOCK", 10**6)
    whole = sorted(map(tuple, chat.parse_transcripts(lines, fitted).collect()))
    assert blocks == whole and len(whole) > 200


def test_chat_edges(spark):
    rows = [(None, 0, "user", "no id"), (1, None, "user", "no turn"), (1, 0, None, None), (1, 0, "user", "same"), (1, 0, "user", "same"),
            (2, 0, "user", ""), (3, 0, "assistant", "x\n\n\ny"), (1, 1, "assistant", "w " * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({n: F.lit(n) for n in ("block", "conv", "marker", "state")})
    lines = chat.transcript_lines(df)
    for fitted in (chat.fit_chat_model(lines), chat.fit_chat_model(lines.limit(0))):
        found = chat.render(chat.parse_transcripts(lines, fitted)).collect()
        text = "".join(r["text"] for r in found)
        assert text.count("same") == 1 and "no id" in text and "no turn" in text
        assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") and r["rendered"].endswith("\n<|end|>\n") for r in found)
    assert math.isfinite(fitted.start.sum())
    assert chat.parse_transcripts(lines.limit(0), fitted).count() == 0


@pytest.mark.parametrize(
    ("line", "speaker"),
    [("User: hi", 2), ("### Human:", 2), ("<|assistant|>", 3), ("Q: why", 2), ("**Assistant**: yes", 3), ("[system] x", 1),
     ("Name of me: x", 4), ("no marker here", 0), ("it is 10:30", 0), ("", 0)],
)
def test_speaker_markers(spark, line, speaker):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(chat._speaker()).first()[0] == speaker


def test_groups_span_batches():
    rows = [{"conv": c, "block": b, "n": n} for n, (c, b) in enumerate([("a", 0), ("a", 0), ("a", 1), ("b", 1), ("b", 1)])]
    batches = [pa.RecordBatch.from_pylist(rows[:1]), pa.RecordBatch.from_pylist(rows[1:4]), pa.RecordBatch.from_pylist(rows[4:])]
    assert [[r["n"] for r in g] for g in chat._groups(iter(batches))] == [[0, 1], [2], [3, 4]]
