"""Main text of pages: site template removal (p1).

A page is a tree of elements read from its lines: a line with the lines that stand under it, and a line's label with the
value that follows it. Every element's subtree is hashed after masking numbers and the site's own name, and the hashes are
counted per host in Spark over all pages. What the counts of a host say decides:

* a line that recurs on ``SHARE`` of the host's pages is the site's template and goes;
* a label that recurs so (``Tags: ...``, ``Read also: ...``) goes with the value it holds;
* a recurring line under which short lines stand that differ from page to page is the root of a list of other stories; it
  goes with the lines under it, up to the next template line, blank line, paragraph, or line about the page's subject.

What recurs at a low rate is judged by place: around the article it is furniture of the site. Inside it, stock subheads
recur exactly like inline advertising, so a short fixed list of words (``CONTROLS``) decides there.

Defined results: null and empty texts have no lines; blank lines are never reported; residue pages (see ``residue``) take
no part; a line equal to the headline is the article's heading; without any article line all recurring lines go; pages of
a null host are those of one host; repeated rows count as pages of their own.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize, tidy

FRINGE = " \t\r\xa0﻿​"
SPACES = "\xa0\u2009\u202f"
COMMON = 0.01
SHARE, LEAST = 0.05, 3  # of a host's pages, and pages at least, that make an element the host's template
ELSEWHERE = 3  # pages anywhere that make an element recurring
LONG = 150  # letters from which a line that isn't template is a paragraph of the article
LONGEST_MASKED = 140  # letters up to which lines are compared without their numbers
VARIED = 16  # headlines (64 at most are told apart) that show an element of the site, whatever recurs with it
LONGEST_UNDER = 230  # letters of a line that stands under a root
WIDE = 0.5  # of a host's pages, from which a long line is the site's wherever it stands
LEADS, LED = 0.5, 32  # share of a root's pages with a short line under it, and how many of these must differ
ALIKE = 1.5  # times a page's letters: the mean of an element's pages, if the element is what those pages are about
TEMPLATE, ALONE, SITE, MOST, ROOT, LABEL = 1, 2, 4, 8, 16, 32  # flags of a mark, below its position

# Words of lines that address the reader's device or the page's own controls.
CONTROLS = re.compile(
    r"advert|sponsor|story continues|continue reading|loading|skip to|scroll|\bphoto\b|\bfoto\b|share\b|print\b|copy link|comments?\b|min read|listen to|\blike \(|reply|follow\b|save for|text size|newsletter|cookie|subscribe"
    r"|sign (in|up)|log in|anzeige|weiter nach|weiterlesen|werbung|teilen|merken|kommentare?\b|lesezeit|drucken|publicidad|sigue leyendo|anuncio|compartir|comentarios?|lectura|imprimir|guardar|publicité|la suite après|partager"
    r"|commentaires?|lecture|imprimer|enregistrer|audio|e-?mail|javascript|browser|back to top|download|menu",
    re.I,
)
ENDS, QUOTES = ".!?…", "\"”»“'"
NUMBER = re.compile(r"[0-9]+")
LABELLED = re.compile(r"([^:：]{2,24}?)\s?[:：]\s")
CAPITAL = re.compile(r"[A-ZÀ-Ý][\w'-]{3,}")
LINES = "news_id long, site long, letters long, head long, doubt int, places array<int>, keys array<long>, nexts array<int>, capitals array<string>"


def ends_sentence(line: str) -> bool:
    return line[-1:] in ENDS and line != "" or line[-1:] in QUOTES and line[-2:-1] in ENDS and len(line) > 1


def digest(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed) - (1 << 63)


def masked(line: str, host: str | None) -> str:
    """A line without its numbers and the site's name; one that is longer than ``LONGEST_MASKED`` as it is."""
    if len(line) > LONGEST_MASKED:
        return line
    return NUMBER.sub("0", line.replace(host, "\x01") if host else line).lower()


def label_of(line: str, mask: str) -> str:
    """The label of a short line without the end of a sentence: what stands before its colon, else its first three words."""
    if len(line) >= LONG or ends_sentence(line):
        return ""
    if found := LABELLED.match(mask):
        return found[1] + ":"
    words = mask.split(None, 3)
    return " ".join(words[:3]) if len(words) > 3 else ""


class Elements:
    """Reads the elements of pages. What short lines hold is kept from page to page, since a site's lines recur."""

    def __init__(self):
        self.memo: dict[tuple[str, str], tuple[int, int, bool, list[str]]] = {}

    def read(self, host: str, line: str) -> tuple[int, int, bool, list[str]]:
        """Key, key of the label (0: none), whether it is short and ends no sentence, and the capitalised words of a line."""
        mask = masked(line, host)
        short = len(line) < LONG and not ends_sentence(line)
        label = label_of(line, mask) if short else ""
        out = digest(mask), digest(label, 1) if label else 0, short, CAPITAL.findall(line) if len(line) >= 30 else []
        if len(self.memo) > 200_000:
            self.memo.clear()
        self.memo[host, line] = out
        return out

    def of(self, host: str, headline: str, text: str) -> tuple[list[int], list[int], list[int], list[str]]:
        """Places and keys of a page's elements (a label's place is that of its line, as ``~place``), for each the bit (of
        64) of the short line that stands under it (-1: none does; -2: the key has come before), and the capitalised words
        of its short lines."""
        if not text.isascii():
            for space in SPACES:
                text = text.replace(space, " ")
        places, keys, nexts, labels, capitals, known = [], [], [], {}, [], set()
        get = self.memo.get
        for place, line in enumerate(text.split("\n")):
            line = line.strip(FRINGE)
            if not line:
                continue
            if len(line) > LONGEST_UNDER:
                key, label, short = digest(line), 0, False
            else:
                key, label, short, found = get((host, line)) or self.read(host, line)
                capitals += found
                if line == headline:
                    label, short = 0, False
            if short and nexts and nexts[-1] == -1:
                nexts[-1] = (key >> 7) & 63
            places.append(place)
            keys.append(key)
            nexts.append(-2 if key in known else -1)
            known.add(key)
            if label:
                labels[~place] = label
        for place, label in labels.items():
            places.append(place)
            keys.append(label)
            nexts.append(-2 if label in known else -1)
            known.add(label)
        return places, keys, nexts, list(set(capitals))


def hashed_lines(pages: DataFrame, screen=None) -> DataFrame:
    """``LINES`` of each page (news_id, host, headline, text) with a text, made once for all later passes. ``head`` has one
    of 64 bits for the headline (of the id, where it is blank); ``doubt`` is what ``screen(headlines, texts)`` says of it."""

    def run(batches):
        elements = Elements()
        for b in batches:
            hosts, heads = ([x if isinstance(x, str) else "" for x in b[c]] for c in ("host", "headline"))
            texts, out = b["text"].tolist(), []
            doubts = screen([h.strip() for h in heads], texts) if screen else [0] * len(texts)
            for key, host, headline, text, doubt in zip(b["news_id"], hosts, heads, texts, doubts):
                bare = headline.strip()
                bit = digest(bare.lower()) & 63 if bare else digest(str(key)) & 63
                out.append((key, digest(host) if host else 0, len(text), (1 << bit) - (1 << 64 if bit == 63 else 0), int(doubt), *elements.of(host, bare, text)))
            yield pd.DataFrame(out, columns=[c.strip().split(" ")[0] for c in LINES.split(",")])

    return materialize(pages.filter("text IS NOT NULL").select("news_id", "host", "headline", "text").mapInPandas(run, LINES), "lines")


def element_counts(lines: DataFrame) -> DataFrame:
    """site, h, here, letters, heads, leads, led, all of the elements that more than one page carries: pages of the host,
    their letters, the bits of their headlines, the pages on which a short line stands under the element and the bits of
    those lines, and pages of all hosts."""
    once = lines.select("site", "letters", "head", F.explode(F.arrays_zip(F.col("keys").alias("h"), F.col("nexts").alias("next"))).alias("e")).select("site", "letters", "head", "e.h", "e.next").filter("next > -2")
    follows = F.col("next") >= 0
    per_host = once.groupBy("site", "h").agg(
        F.count(F.lit(1)).alias("here"), F.sum("letters").alias("letters"), F.bit_or("head").alias("heads"), F.count_if(follows).alias("leads"), F.bit_or(F.when(follows, F.expr("shiftleft(1L, next)")).otherwise(F.lit(0))).alias("led")
    )
    # one row a host here, so the window holds the hosts that share an element
    return per_host.withColumn("all", F.sum("here").over(Window.partitionBy("h"))).filter("all >= 2")


def host_sizes(lines: DataFrame) -> DataFrame:
    """size_site, host_pages, host_heads: pages of each host and the bits of their headlines."""
    return lines.groupBy(F.col("site").alias("size_site")).agg(F.count(F.lit(1)).alias("host_pages"), F.bit_or("head").alias("host_heads"))


def flagged(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """r_key, flags, all, mean: what the elements' counts make of them, and the mean letters of their pages."""
    template = F.col("here") >= F.greatest(F.lit(float(LEAST)), SHARE * F.col("host_pages"))
    # copies of an article stand under one headline or few, elements of the site under as many as there are pages
    varied = F.bit_count("heads") >= F.least(F.lit(float(VARIED)), F.col("here") / 2, F.bit_count("host_heads") / 2)
    root = template & (F.col("leads") >= LEADS * F.col("here")) & (F.bit_count("led") >= F.least(F.lit(float(LED)), 0.75 * F.col("leads")))
    flags = [(template, TEMPLATE), (template & varied, SITE), (template & varied & (F.col("here") >= WIDE * F.col("host_pages")), MOST), (root, ROOT)]
    sized = counts.join(sizes, F.col("site") == F.col("size_site"))
    return sized.select(F.xxhash64("site", "h").alias("r_key"), sum(F.when(c, F.lit(bit)).otherwise(F.lit(0)) for c, bit in flags).alias("flags"), "all", (F.col("letters") / F.col("here")).alias("mean"))


def with_counts(pages: DataFrame, lines: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """``pages`` (news_id, ...) with doubt, and marks and counts of recurring elements: places with their flags, and pages
    of all hosts. With ``chosen`` (of ``lines``), only those pages."""
    recurring = flagged(element_counts(lines), host_sizes(lines))
    own = lines if chosen is None else chosen
    placed = own.select("news_id", "site", "letters", F.explode(F.arrays_zip(F.col("places").alias("p"), F.col("keys").alias("k"))).alias("e")).select("news_id", "letters", "e.p", F.xxhash64("site", "e.k").alias("key"))
    alone = F.when(F.col("mean") <= ALIKE * F.col("letters"), F.lit(ALONE)).otherwise(F.lit(0))
    place = F.when(F.col("p") < 0, -F.col("p") - 1).otherwise(F.col("p")).cast("long")
    mark = F.shiftleft(place, 8) + F.col("flags") + alone + F.when(F.col("p") < 0, F.lit(LABEL)).otherwise(F.lit(0))
    marked = placed.join(recurring, F.col("key") == F.col("r_key")).select("news_id", mark.alias("mark"), "all")
    # pages with nothing that recurs have their doubt, too
    marks = marked.unionByName(own.filter("doubt > 0").select("news_id", F.lit(-1).cast("long").alias("mark"), F.col("doubt").cast("long").alias("all")))
    # written, so that the shuffles of the counts go before texts are moved, and its size decides whether they are
    marks = materialize(marks.groupBy("news_id").agg(F.collect_list("mark").alias("marks"), F.collect_list("all").alias("counts")), "marks")
    tidy(pages.sparkSession)
    return pages.drop("host").join(marks, "news_id", "left" if chosen is None else "inner")


def common_capitals(lines: DataFrame) -> frozenset:
    """Capitalised words that the short lines of at least ``COMMON`` of all pages carry: at most words-of-a-page / COMMON
    of them, some thousands at any number of pages. Counted over all pages."""
    counted = lines.select(F.explode("capitals").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.filter(F.col("n") >= max(5, COMMON * lines.count())).select("w").collect()
    return frozenset(r["w"] for r in rows)


def pages_of(news: DataFrame) -> DataFrame:
    """Records without an id can't be reported and are left out."""
    return news.filter("news_id IS NOT NULL").select("news_id", F.col("source.name").alias("host"), F.col("source.url").alias("url"), F.col("content.headline").alias("headline"), F.col("content.full_text").alias("text"))


class Page:
    """Lines of one page with what they are: ``T`` template, ``R`` recurring, ``U`` its own, blank ``''``."""

    def __init__(self, headline: str | None, text: str, marks=(), counts=(), common: frozenset = frozenset()):
        self.common = common
        self.lines = [x.strip(FRINGE) for x in text.split("\n")]
        self.headline = (headline or "").strip()
        n = len(self.lines)
        flags, everywhere = [0] * n, [1] * n
        self.doubt = 0
        self.labelled: set[int] = set()
        for m, count in zip(marks, counts):
            m, count = int(m), int(count)
            if m < 0:
                self.doubt = count
            elif (place := m >> 8) < n:
                if m & LABEL:
                    if m & TEMPLATE:
                        self.labelled.add(place)
                else:
                    flags[place], everywhere[place] = m & 255, count
        self.alone = {i for i, f in enumerate(flags) if f & ALONE}  # recurring lines that only pages as short as this one carry
        self.roots = {i for i, f in enumerate(flags) if f & ROOT}
        size = [len(x) for x in self.lines]
        of_site = self._long_template(flags, size)
        # copies of one article share all their paragraphs: what recurs no more than those is not the site's
        long_counts = sorted(c for c, s, site in zip(everywhere, size, of_site) if s >= LONG and c >= 2 and not site)
        copies = 1.5 * long_counts[len(long_counts) // 2] if len(long_counts) >= 2 and long_counts[len(long_counts) // 2] > 1 else 0
        self.kind = kind = []
        for i, s in enumerate(size):
            if not s:
                kind.append("")
            elif s > 40 and everywhere[i] <= copies:
                kind.append("U")
            elif s > LONGEST_MASKED:
                kind.append("T" if of_site[i] else "U")
            else:
                kind.append("T" if flags[i] & TEMPLATE else "R" if everywhere[i] >= ELSEWHERE else "U")
        self.paragraphs = [i for i in range(n) if kind[i] == "U" and size[i] >= LONG]
        self.under = self._subtrees()

    def _long_template(self, flags: list[int], size: list[int]) -> list[int]:
        """Which long lines are the site's. A passage that articles share recurs like one, but stands between paragraphs:
        on under ``WIDE`` of the host's pages, a long line must have short template lines, or the page's end, around it."""
        of_site = [f & SITE and (s <= LONGEST_MASKED or f & MOST) for f, s in zip(flags, size)]
        if not any(f & SITE and s > LONGEST_MASKED and not f & MOST for f, s in zip(flags, size)):
            return of_site
        shown = [i for i, s in enumerate(size) if s]
        long = [bool(flags[i] & SITE and size[i] > LONGEST_MASKED) for i in shown]
        for at, i in enumerate(shown):
            if long[at] and not flags[i] & MOST:
                a = next((k for k in range(at - 1, -1, -1) if not long[k]), None)
                b = next((k for k in range(at + 1, len(shown)) if not long[k]), None)
                beside = [flags[shown[k]] & TEMPLATE and size[shown[k]] <= LONGEST_MASKED for k in (a, b) if k is not None]
                of_site[i] = bool(beside) and all(beside)
        return of_site

    def coherent(self, line: str) -> bool:
        """Whether a line names the page's subject: a capitalised word, not common in the corpus, that two paragraphs hold
        (the line itself, if it is one), or a paragraph and the headline."""
        need = 1 if len(line) >= LONG else 2
        for word in CAPITAL.findall(line):
            if word not in self.common:
                seen = word in self.headline
                for i in self.paragraphs:
                    x = self.lines[i]
                    if word in x and x is not line:
                        seen += 1
                        if seen >= need:
                            return True
                if seen >= need:
                    return True
        return False

    def _subtrees(self) -> set[int]:
        """Roots of lists of other stories with the lines under them."""
        out: set[int] = set()
        for root in sorted(self.roots):
            if root in out or self.kind[root] not in ("T", "R"):
                continue
            out.add(root)
            j = root + 1
            while j < len(self.lines) and self.kind[j] in ("R", "U"):
                x = self.lines[j]
                if x == self.headline or len(x) > LONGEST_UNDER or self.kind[j] == "U" and self.coherent(x):
                    break
                out.add(j)
                j += 1
        return out

    def article(self) -> list[int]:
        """Indexes of the article's lines."""
        n, lines, kind = len(self.lines), self.lines, self.kind
        own = [False] * n
        for i in range(n):
            if i in self.under or not kind[i]:
                continue
            x = lines[i]
            if x == self.headline:
                own[i] = True
            elif kind[i] == "U":
                own[i] = i not in self.labelled
            elif kind[i] == "R":
                own[i] = len(x) > 30 and ends_sentence(x)
        # short lines beyond a template line that have no word of the article are the site's
        for step in (1, -1):
            for i in [i for i in range(n) if own[i]][::step]:
                if len(lines[i]) >= LONG or lines[i] == self.headline or self.coherent(lines[i]):
                    break
                j = i + step
                while 0 <= j < n and not lines[j]:
                    j += step
                if 0 <= j < n and not own[j] and (kind[j] in ("T", "R") or j in self.under):
                    own[i] = False
        at = [i for i in range(n) if own[i]]
        for i in range(at[0] + 1, at[-1]) if at else ():
            if kind[i] == "R" and not own[i] and i not in self.under and len(lines[i]) < 60 and not CONTROLS.search(lines[i]):
                own[i] = True  # a subhead or stock sentence between paragraphs
        return [i for i in range(n) if own[i]]


def boilerplate_lines(page: Page) -> list[int]:
    keep = set(page.article())
    return [i + 1 for i, x in enumerate(page.lines) if x and i not in keep]


def article_text(page: Page) -> str:
    return "\n".join(page.lines[i] for i in page.article())
