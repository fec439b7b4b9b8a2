import html
import random
import re

import pytest
from pyspark.sql import functions as F

from postline.llm.html_text import extract_text, main_text
from tests.llm.conftest import SF


def test_pages_with_marked_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in extract_text(pages).collect()}
    assert len(found) == pages.count()
    for page in pages.collect():
        article = re.search("<article>(.*?)(</article>|<footer>)", page.html, re.DOTALL)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert found[page.page_id].text == "\n".join(b for b in blocks if b)
        assert found[page.page_id].n_chars == len(found[page.page_id].text) and found[page.page_id].url == page.url


LONG = "This is a sentence of the story that goes on for a while, as sentences in stories do. " * 3


@pytest.mark.parametrize(
    "around",
    [
        '<div class="article">{}</div>',
        "<article><header>{}</header></article>",
        "<main>{}</main>",
        "<section>{}</section>",
        "<div><div>{}",
    ],
)
def test_everything_else_goes(around):
    story = f"<h1>A &amp; B</h1>\n<p>{LONG}</p><ul><li>short</li></ul><p>One  <b>t</b>wo<br>three&nbsp;&eacute;</p><p>{LONG}</p><p>End.</p>"
    page = (
        "<!doctype html><html><head><title>T</title><style>p{}</style><script>var a='</p><p>no';</script></head><body>"
        "<header><a href='/'>Home of the site with a long name</a></header><nav><ul><li><a href=x>Menu</a></li></ul></nav>"
        f"<div class='cookie-notice'>{LONG}</div><div id=sidebar>{LONG}</div><aside>{LONG}</aside><div class=ad><p>{LONG}</p></div>"
        + around.format(story)
        + f"<form><p>{LONG}</p><input></form><div class='comments'><div><p>{LONG}</p></div></div>"
        f"<!-- <p>{LONG}</p> --><noscript>{LONG}</noscript><footer>{LONG}</footer></body></html>"
    )
    flat = LONG.strip()
    assert main_text(page) == f"A & B\n{flat}\nshort\nOne two three é\n{flat}\nEnd."


@pytest.mark.parametrize(("name", "kept"), [("has-sidebar", True), ("content with-footer", True), ("comments", False), ("sidebar related", False)])
def test_what_is_named_after_its_neighbours_is_kept_if_it_holds_the_article(name, kept):
    page = f"<body><div class='{name}'><article><p>{LONG}</p></article></div><p>{LONG} else</p></body>"
    assert main_text(page) == (LONG.strip() if kept else f"{LONG}else")


@pytest.mark.parametrize(
    "attributes",
    [
        'class="overflow-hidden"', 'style="overflow:hidden"', 'class="elementor-widget elementor-widget-text-editor"', 'class="content has-sidebar"',
        'class="related-work"', 'id="form-page"', 'class="skip-x"', 'data-hidden="no"', 'title="display:none"',
    ],
)
@pytest.mark.parametrize("around", ["<div {}><article>{}</article></div>", "<main><div {}>{}</div></main>", "<div {}>{}</div>"])
def test_names_that_only_hold_a_word_cut_nothing(attributes, around):
    other = f"<div class='site-footer'><p>{LONG}</p></div>"
    assert main_text("<body>" + around.format(attributes, f"<p>{LONG}</p>") + other + "</body>") == LONG.strip()


@pytest.mark.parametrize("attributes", ["hidden", "hidden=''", "style='color:red; DISPLAY : none !important'", "style=visibility:hidden", "aria-hidden=true", "class='a post-comments'", "id='ad_slot_2'", "class=site-footer"])
def test_hidden_and_named_elements_go(attributes):
    assert main_text(f"<body><div {attributes}><p>{LONG} not</p></div><p>{LONG}</p></body>") == LONG.strip()


@pytest.mark.parametrize("start", ["<form id=aspnetForm>", "<div class=social>", "<div hidden>", "<form><div class=social><div class=related>", "<aside>" * 5])
def test_what_is_cut_is_put_back_if_nothing_surges_without_it(start):
    ends = "".join(f"</{name}>" for name in reversed(re.findall(r"<(\w+)", start)))
    page = f"<body><nav><p>Menu</p></nav>{start}<p>{LONG}</p><p>{LONG}</p>{ends}<footer>Imprint</footer></body>"
    assert main_text(page) == f"{LONG.strip()}\n{LONG.strip()}"


def test_deeply_nested_elements_lose_nothing():
    assert LONG.strip() in main_text(f"<body>{'<aside>' * 50}<p>{LONG}</p>{'</aside>' * 50}</body>")


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ("<svg width='1'/>", ""), ("<svg><path d='x'/><text>no</text></svg>", ""), ("<iframe src='x'/>", ""), ("<iframe src='x'>", ""),
        ("<iframe src=x>no</iframe>", ""), ("<select><option>no</select>", ""), ("<textarea>", ""), ("<template/>", ""),
        ("<iframe src=a><p>yes</p><iframe src=b></iframe>", "yes\n"), ("<math><mi>x</mi></math>", "x"), ("<canvas>drawn</canvas>", "drawn"),
        ("<object data=a>seen</object>", "seen"), ("<xmp>as it is</xmp>", "as it is\n"), ("<script/>no</script>", ""), ("<style>no</style>", ""),
    ],
)
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div>{}</div>"])
def test_odd_elements_take_nothing_with_them(inside, text, around):
    page = around.format(f"<p>{LONG}</p>{inside}<p>{LONG}</p><p>Let {inside} hold, {LONG}</p><p>{LONG}</p>")
    found = main_text(f"<body><nav>Menu</nav>{page}</body>")
    assert found.count(LONG.strip()) == 4 and found.count("no") == 0 and "Menu" not in found
    assert found.count(text.strip()) >= 2 if text else "Let hold" in found


def test_many_unclosed_elements_are_read_in_one_pass():
    assert main_text("<iframe src=x>" * 20_000 + f"<p>{LONG}</p>") == LONG.strip()


def windows(weights, size=3):
    """Every run of `size` lines that overlaps the page, with its first and last line and its text."""
    runs = [range(max(0, at), min(len(weights), at + size)) for at in range(1 - size, len(weights))]
    return [(run[0], run[-1], sum(weights[i] for i in run)) for run in runs]


def surge_and_dive(weights):
    """The lines from where the sums first rise over the level to where they fall below it for good."""
    found = windows(weights)
    level = min(120, 0.2 * max(total for *_, total in found))
    high = [(first, last) for first, last, total in found if total > level]
    lines = [i for i in range(high[0][0], high[-1][1] + 1)]
    real = [i for i in lines if weights[i]]
    return list(range(real[0], real[-1] + 1))


@pytest.mark.parametrize("seed", range(40))
def test_lengths_alone_against_all_windows(seed):
    """Pages without marks or names: lines of many lengths, empty stretches, and links that do not count."""
    rng = random.Random(seed)
    lines = []
    for _ in range(rng.randint(1, 40)):
        kind = rng.choice(["text", "text", "short", "link"])
        length = rng.randint(60, 400) if kind == "text" else rng.randint(1, 30)
        lines.append(("".join(rng.choices("abcdef ", k=length)).strip() or "x", kind == "link"))
    page = "".join(f"<p><a href=x>{text}</a></p>" if link else f"<p>{text}</p>" for text, link in lines)
    texts = [" ".join(text.split()) for text, _ in lines]
    weights = [0 if link else len(text) for text, (_, link) in zip(texts, lines)]
    want = "\n".join(texts[i] for i in surge_and_dive(weights)) if any(weights) else ""
    assert main_text(f"<body>{page}</body>") == want


def test_forms_around_the_main_element_are_kept():
    assert main_text(f"<body><form><nav>{LONG}</nav><main><p>{LONG}</p></main></form><p>{LONG}</p></body>") == LONG.strip()


@pytest.mark.parametrize("teaser", ["<article><p>A short teaser.</p></article>", "<main><h1>Title</h1></main>", f"<article><p>{LONG}</p></article>"])
def test_marks_do_not_silence_a_longer_story_outside(teaser):
    story = "".join(f"<p>{i} {LONG}</p>" for i in range(8))
    text = main_text(f"<body><nav><a href=x>Menu</a></nav>{teaser}<div>{story}</div><footer>{LONG}</footer></body>")
    assert "\n".join(f"{i} {LONG.strip()}" for i in range(8)) in text and "Menu" not in text


def test_marks_outweigh_what_surges_less():
    page = f"<body><p>{LONG} else</p><article><h1>T</h1><p>{LONG}</p><p>{LONG}</p><p>End.</p></article><p>{LONG} else</p></body>"
    assert main_text(page) == f"T\n{LONG.strip()}\n{LONG.strip()}\nEnd."


def test_lines_without_names_are_told_by_their_lengths():
    links = "".join(f"<div><a href='/{i}'>Link number {i}</a></div>" for i in range(12))
    page = f"<body>{links}<p>{LONG}</p><p>Yes.</p><p>{LONG}</p>{links}</body>"
    assert main_text(page) == f"{LONG.strip()}\nYes.\n{LONG.strip()}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("plain words", "plain words"), ("<p>short", "short"), ("a < b and c > d", "a < b and c > d"),
        ("<nav>x", "x"), ("<p>x</p><script>var y", "x"), ("<p title='a>b'>x</p>", "x"), ("<p>x<br", "x"), ("<article></article>", ""),
        ("<p>&#233;&lt;b&gt;&unknown;</p>", "é<b>&unknown;"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, "<p>a</p>"), (None, "u", "<p>" + "b " * 200_000 + "</p>"), (2, None, "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(5)).withColumn("n_chars", F.lit(5))
    found = sorted((str(r.page_id), r.n_chars) for r in extract_text(pages).collect())
    assert found == [("1", 0), ("2", 1), ("2", 1), ("None", 399_999)]
    assert extract_text(pages.limit(0)).count() == 0
