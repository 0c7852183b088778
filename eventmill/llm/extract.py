"""HTML extraction: main text of a page by a recurrent block labeller.

A page is a sequence of leaf blocks; a bidirectional LSTM (``labeller.py``) reads their
hashed tag paths, hashed words and shape and labels each with the whole page in view.
Blocks labelled as main text are joined in page order.

Fit: pages carry no labels, so the network learns from made pages with known labels.
Their paragraphs and their menu, advert and footer texts come from a stable sample of
``sample`` whole real pages of ``chars`` in all (documented bounds), set into random layouts: semantic tags or
plain divisions, usual, odd or missing class names, notices, forms, side columns and
reader comments around and inside the article. The sampled pages take part as well,
labelled by their semantic tags where they have an article.

Nulls: a null or empty page, and one without main text, gives an empty text. Rows that
repeat are extracted each. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.blocks import ARTICLE, BOILER, WIDTH, leaf_blocks, vectors
from eventmill.llm.common import pages
from eventmill.llm.labeller import BlockLabeller

SAMPLE = 160
SAMPLE_CHARS = 8_000_000  # of all sampled pages together
STRETCH = 120  # blocks of a page learned at a time
MADE = 520
CUT = 0.5

# Names under which layouts hang their parts, as "tag.class".
MAIN = (
    "article main main>article div.content div#content div.post div.entry-content div.article-body "
    "section.story div#main div.text article.post div.main>div.body div.page-content section div "
    "div.wrapper>div.container>article td.content div.hentry article.entry main#content"
).split()
HEADER = "header div.header div#header div.masthead div.top-bar header.site-header div.branding".split()
MENU = "nav ul.menu div.menu nav.main-nav div#navigation ul.nav div.breadcrumbs nav.navbar".split()
NOTICE = (
    "div.cookie div.cookie-banner div#consent div.notice section.alert p.gdpr div.popup div.modal "
    "div.disclaimer div.subscribe-notice div.cookie-notice aside.notice"
).split()
ADVERT = (
    "div.ad div.ads div.advert div.advertisement div.banner div#google_ads aside.sponsored div.promo "
    "section.promotion div.ad-slot div.sponsor"
).split()
SIDE = (
    "aside div.sidebar div#sidebar div.right-col div.widget div.related aside.related section.more "
    "div.trending ul.recent-posts div.share div.social div.tags aside.sidebar"
).split()
FORM = "form form.search form.newsletter form.login div.signup>form form#contact".split()
FOOTER = "footer div.footer div#footer footer.site-footer div.bottom div.copyright div.legal".split()
COMMENTS = (
    "section.comments div#comments div.comments div.comment-list ol.commentlist div.responses "
    "section#discussion div.disqus article.comment div.reader-comments section.comment-section"
).split()


class Maker:
    """Random pages with a label for every block."""

    def __init__(self, main: list[str], other: list[str], seed: int):
        self.main = main or ["A longer run of plain text, with commas, and an end."]
        self.other = other or ["Read more"]
        self.rng = random.Random(seed)

    def nested(self, name: str, inner: str, plain: float = 0.15) -> str:
        """``inner`` inside the elements of a name such as "div.menu>ul"."""
        for part in reversed(name.split(">")):
            tag, mark = part, ""
            for sign, attr in (("#", "id"), (".", "class")):
                if sign in part:
                    tag, value = part.split(sign)
                    draw = self.rng.random()
                    if draw < 0.1:
                        value = f"x{self.rng.randrange(10**5):05d}"
                    mark = "" if draw > 1 - plain else f' {attr}="{value}"'
            inner = f"<{tag}{mark}>{inner}</{tag}>"
        return inner

    def words(self, low: int, high: int) -> str:
        text = self.rng.choice(self.main + self.other).split()
        at = self.rng.randrange(max(1, len(text) - high))
        return " ".join(text[at : at + self.rng.randint(low, high)])

    def links(self, low: int, high: int) -> str:
        n = self.rng.randint(low, high)
        style = self.rng.random()
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(n)]
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if style < 0.8 else " ").join(items)

    def short(self) -> str:
        return self.rng.choice(self.other) if self.rng.random() < 0.6 else self.words(3, 25)

    def form(self) -> str:
        return (
            f"<label>{self.words(1, 3)}</label><input type=text>"
            f"<p>{self.words(2, 10)}</p><button>{self.words(1, 2)}</button>"
        )

    def comments(self) -> str:
        out = [f"<h3>{self.words(1, 3)}</h3>"] if self.rng.random() < 0.7 else []
        for _ in range(self.rng.randint(1, 6)):
            text = self.rng.choice(self.main) if self.rng.random() < 0.5 else self.words(3, 40)
            kind = self.rng.choice(["li.comment", "div.comment", "article.comment", "div.comment-body", "p"])
            out.append(self.nested(kind, f"<p>{text}</p>" if kind != "p" else text))
        return "".join(out)

    def outside(self, kind: str) -> str:
        names, inner = {
            "header": (HEADER, lambda: f"<h2>{self.words(1, 5)}</h2>" + (self.links(2, 6) if self.rng.random() < 0.5 else "")),
            "menu": (MENU, lambda: self.links(2, 12)),
            "notice": (NOTICE, lambda: f"<p>{self.short()}</p>" if self.rng.random() < 0.6 else self.short()),
            "advert": (ADVERT, lambda: self.short()),
            "side": (SIDE, lambda: f"<h4>{self.words(1, 4)}</h4>" + (self.links(2, 8) if self.rng.random() < 0.6 else f"<p>{self.short()}</p>")),
            "form": (FORM, self.form),
            "footer": (FOOTER, lambda: f"&copy; {self.words(1, 3)} &middot; {self.short()}" if self.rng.random() < 0.6 else self.links(2, 6) + f"<p>{self.short()}</p>"),
            "comments": (COMMENTS, self.comments),
        }[kind]
        return self.nested(self.rng.choice(names), inner())

    def page(self) -> tuple[list, list[int]]:
        """Blocks and labels; every part is parsed inside its own surroundings."""
        rng = self.rng
        parts: list[tuple[int, str]] = []
        maybe = lambda p, kind: parts.append((0, self.outside(kind))) if rng.random() < p else None
        for p, kind in ((0.4, "notice"), (0.5, "header"), (0.8, "menu"), (0.4, "advert"), (0.2, "side"), (0.2, "form")):
            maybe(p, kind)
        main: list[tuple[int, str]] = []
        if rng.random() < 0.8:
            title = rng.choice(self.main)[: rng.randint(15, 70)]
            main.append((1, f"<{'h1' if rng.random() < 0.8 else 'h2'}>{title}</h1>"))
        for _ in range(rng.choice([1, 2, 3, 4, 6, 8, 12, 20])):
            text = rng.choice(self.main) if rng.random() < 0.75 else self.words(1, 12)
            shape = rng.random()
            if shape < 0.8:
                main.append((1, f"<p>{text}</p>" if rng.random() < 0.8 else f"<p><b>{text}<br>"))
            elif shape < 0.86:
                main.append((1, f"<h2>{self.words(1, 8)}</h2>"))
            elif shape < 0.92:
                main.append((1, "<ul>" + "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(3)) + "</ul>"))
            elif shape < 0.96:
                main.append((1, f"<blockquote><p>{text}</p></blockquote>"))
            else:
                main.append((1, f"<div>{text}</div>"))
            if rng.random() < 0.05:
                main.append((0, self.outside(rng.choice(["advert", "side", "form", "notice", "menu"]))))
        if rng.random() < 0.15:
            main.append((0, self.outside("comments")))
        shell = rng.choice(MAIN)
        after: list[tuple[int, str]] = []
        for p, kind in ((0.3, "comments"), (0.35, "side"), (0.25, "advert"), (0.2, "form"), (0.15, "notice"), (0.15, "menu"), (0.8, "footer")):
            if rng.random() < p:
                after.append((0, self.outside(kind)))
        if rng.random() < 0.3:
            shell = "div.page>" + shell
        open_tags, _, close_tags = self.nested(shell, "\0", plain=0.1).partition("\0")
        blocks, labels = [], []
        for group, before, behind in ((parts, "", ""), (main, open_tags, close_tags), (after, "", "")):
            for label, text in group:
                found = leaf_blocks("<body>" + before + text + behind)
                blocks += found
                labels += [label] * len(found)
        return blocks, labels


def semantic_labels(blocks: list) -> list[int] | None:
    """Labels of a page whose tags say what is the article; None if they do not."""
    marks = [block.path.marks if block.path else frozenset() for block in blocks]
    out = [int(bool(m & ARTICLE) and not m & BOILER) for m in marks]
    return out if any(out) and not all(out) else None


def train(sample: list[str], made: int = MADE, seed: int = 5) -> BlockLabeller:
    """A labeller from sampled pages and pages made of their texts."""
    sequences, targets, main, other = [], [], [], []
    for page in sample:
        blocks = leaf_blocks(page)
        labels = semantic_labels(blocks)
        if labels is None:
            continue
        sequences.append(vectors(blocks))
        targets.append(np.asarray(labels, np.float32))
        for block, label in zip(blocks, labels, strict=True):
            (main if label else other).append(block.text)
    maker = Maker([t for t in main if len(t) > 20], other, seed)
    for _ in range(made):
        blocks, labels = maker.page()
        if blocks:
            sequences.append(vectors(blocks))
            targets.append(np.asarray(labels, np.float32))
    # A long page is learned stretch by stretch, whole, so that batches stay even.
    cuts = [(s, t, at) for s, t in zip(sequences, targets, strict=True) for at in range(0, len(s), STRETCH)]
    sequences = [s[at : at + STRETCH] for s, _, at in cuts]
    targets = [t[at : at + STRETCH] for _, t, at in cuts]
    return BlockLabeller(WIDTH).fit(sequences, targets)


def fit_labeller(
    df: DataFrame, id_col: str, html_col: str, sample: int = SAMPLE, chars: int = SAMPLE_CHARS
) -> BlockLabeller:
    """Learn from at most ``sample`` whole pages, in order of a hash, of ``chars`` in all.

    A page that no longer fits is passed over, whatever its length, and the next one tried.
    """
    usable = df.filter(F.length(html_col) > 0)
    total = usable.count()
    drawn = F.pmod(F.xxhash64(F.lit("extract"), F.col(id_col)), F.lit(1_000_000)) / 1e6
    near = usable.filter(drawn < min(1.0, 2.0 * sample / max(1, total))).select(
        F.xxhash64(id_col, html_col).alias("_h"), F.col(html_col).alias("_page")
    )
    chosen, left = [], chars
    for r in near.select("_h", F.length("_page").alias("n")).distinct().orderBy("_h").limit(2 * sample).collect():
        if r["n"] <= left and len(chosen) < sample:
            chosen.append(r["_h"])
            left -= r["n"]
    rows = near.filter(F.col("_h").isin(chosen)).dropDuplicates(["_h"]).orderBy("_h").collect() if chosen else []
    return train([r["_page"] for r in rows])


def main_texts(found: list[list], labeller: BlockLabeller) -> list[str]:
    chances = labeller.predict([vectors(b) for b in found])
    return [
        "\n".join(b.text for b, c in zip(blocks, chance, strict=True) if c >= CUT)
        for blocks, chance in zip(found, chances, strict=True)
    ]


def extract(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    labeller: BlockLabeller | None = None,
    rows_at_a_time: int = 128,
) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    known = labeller or fit_labeller(df, id_col, html_col)
    names = ["page_id", "url", "text", "n_chars"]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_a_time):
                part = batch.slice(start, rows_at_a_time)
                texts = main_texts([leaf_blocks(h) for h in part.column(2).to_pylist()], known)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=names,
                )

    rows = df.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), html_col)
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(pages(spark, sf_dir))
