"""Main text of web pages by consensus host paths.

Each page's containers are scored by how much running text they hold. The pages
of a host vote with their best container on generalised tag-class paths; every
page is then extracted again from the container on the path its host has chosen,
whatever that page's own scores say. Texts that the extracted containers share
with what lies outside them (share buttons, notices put into the body) are voted
out in the same way, over all hosts.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.session import cut

_DROPPED = re.compile(r"<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_NAME = re.compile(r"<(/?)\s*([a-zA-Z][a-zA-Z0-9]*)")
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_DIGITS = re.compile(r"[0-9٠-٩]+")

CONTAINERS = frozenset("body div td th nav aside article section main footer header form".split())
LAYOUT = frozenset("html head table tbody thead tr ul ol dl".split())
VOID = frozenset("br img hr meta link input area base col embed source track wbr".split())
#: An open element of the key's kind is closed by a new one of the same kind.
SIBLINGS = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "p": CONTAINERS | {"li"}, "option": {"select"}}

#: A path is main if at least this share of its containers won their page.
WIN_SHARE = 0.5
#: A text is boilerplate if at least this share of its pages have it outside the main container.
OUT_SHARE, OUT_PAGES = 0.1, 2

SCHEMA = (
    "page_id long, host string, "
    "containers array<struct<cid:int,path:string,score:double,best:boolean>>, "
    "runs array<struct<run_no:int,within:array<int>,heading:boolean,run_hash:long,block_hash:long,lead_hash:long,text:string>>"
)
#: What is voted on: the stretch between two tags, its whole block, and what the block has in front of its last colon
#: (lists of other instruments name each in one form, whatever its title).
VOTED = ("run_hash", "block_hash", "lead_hash")


class _Element:
    __slots__ = ("name", "cls", "no", "parent", "children", "words", "links", "h1")

    def __init__(self, name, cls, no, parent):
        self.name, self.cls, self.no, self.parent = name, cls, no, parent
        self.children, self.words, self.links, self.h1 = 0, 0, 0, False


def masked(text: str) -> str:
    return " ".join(_DIGITS.sub("#", entities.unescape(text)).split()).lower()


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def parse_runs(html: str) -> list[tuple[str, list[_Element]]]:
    """(raw text, open elements) of every stretch between tags that is not just white space.

    Tags are matched leniently: an end tag closes what was left open inside it,
    and is ignored if nothing of its name is open.
    """
    html = _DROPPED.sub("", html)
    stack, out, last, no = [], [], None, 0
    for m in _TAG.finditer(html):
        if last is not None:
            text = html[last : m.start()]
            if text.strip():
                out.append((text, list(stack)))
        last = m.end()
        tag = m.group()
        named = _NAME.match(tag)
        if not named:
            continue
        name = named.group(2).lower()
        if named.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            continue
        if name in VOID or tag.endswith("/>"):
            continue
        closes = SIBLINGS.get(name)
        if name in CONTAINERS or name in ("table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6"):
            closes = (closes or set()) | {"p"}
        if closes:
            scope = _SCOPE.get(name, CONTAINERS)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in closes:
                    del stack[i:]
                    break
                if stack[i].name in scope:
                    break
        cls = _CLASS.search(tag)
        cls = next((g for g in cls.groups() if g), "") if cls else ""
        element = _Element(name, cls.lower(), no, stack[-1] if stack else None)
        if stack and name not in ("a", "b", "i", "em", "u", "br", "sup", "sub", "font"):
            stack[-1].children += 1
        no += 1
        stack.append(element)
    return out


def _kind(element: _Element) -> str:
    """The class if there is one (layouts change the tag but keep it), else the tag."""
    return _DIGITS.sub("#", "." + ".".join(element.cls.split())) if element.cls else "td" if element.name == "th" else element.name


def analyse(html: str, texts: bool = True) -> tuple[list[tuple], list[tuple]]:
    """The containers and runs of a page, in the form of ``SCHEMA``."""
    parsed = parse_runs(html)
    blocks: dict[int, list[str]] = {}
    rows, containers = [], {}
    for no, (text, stack) in enumerate(parsed):
        names = {e.name for e in stack}
        # A div or cell that holds nothing but text is a paragraph, not a container.
        chain = [e for e in stack if e.name in CONTAINERS and (e.children or e.name == "body")]
        block = next((e for e in reversed(stack) if e.name not in ("a", "b", "i", "em", "u", "sup", "sub", "font")), None)
        if "title" in names or "head" in names or not chain:
            rows.append((no, [], False, text, None))
            continue
        own, words = chain[-1], len(text.split())
        containers.update((e.no, e) for e in chain)
        if "a" in names or "button" in names:
            own.links += words
        else:
            own.words += words
        own.h1 |= "h1" in names
        key = block.no if block not in chain else -1 - no
        blocks.setdefault(key, []).append(text)
        rows.append((no, [e.no for e in chain], "h1" in names, text, key))
    best, top = None, 0.0
    scored = []
    for e in containers.values():
        # A path ends with whether the container has the page's heading of its own.
        path = [_kind(e)]
        up = e.parent
        while up is not None and up.name != "body":
            if up.name in CONTAINERS and up.cls:
                path.append(_kind(up))
            up = up.parent
        signature = ">".join(reversed(path[:2])) + ("|h1" if e.h1 else "|")
        score = float(e.words - 2 * e.links + (20 if e.h1 else 0))
        scored.append((e.no, signature, score))
        if score > top and score >= 12:
            best, top = e.no, score
    whole = {k: masked(" ".join(v)) for k, v in blocks.items()}
    runs = []
    for no, within, heading, text, key in rows:
        block = whole.get(key, "")
        lead, colon, _ = block.rpartition(":")
        runs.append((no, within, heading, _hash(masked(text)), _hash(block), _hash(lead.strip()) if colon else None, text if texts else None))
    return [(cid, path, score, cid == best) for cid, path, score in scored], runs


def _host(url):
    m = re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", url or "", re.I)
    return m.group(1).lower().rpartition("@")[2] if m else ""


def analysed_pages(pages: DataFrame, texts: bool = True) -> DataFrame:
    """One row per page (``SCHEMA``); of repeated rows of a page the greatest counts.

    Pages with null or empty HTML have no containers and no runs. Without ``texts``
    the texts of the runs are null.
    """
    one = pages.where("page_id is not null").groupBy("page_id").agg(F.max(F.struct("content_html", "source_url")).alias("p"))

    def parse(batches):
        for pdf in batches:
            parts = [analyse(h or "", texts) for h in pdf["content_html"]]
            yield pd.DataFrame({
                "page_id": pdf["page_id"], "host": [_host(u) for u in pdf["source_url"]],
                "containers": [p[0] for p in parts], "runs": [p[1] for p in parts],
            })

    return one.select("page_id", "p.content_html", "p.source_url").mapInPandas(parse, SCHEMA)


def _main(parsed: DataFrame) -> DataFrame:
    """(page_id, run_no) of the runs of main text of ``analysed_pages``."""
    boxes = parsed.select("page_id", "host", F.explode("containers").alias("c")).select("page_id", "host", "c.*")
    votes = boxes.groupBy("host", "path").agg((F.avg(F.col("best").cast("double"))).alias("share"))
    # One host may hold any share of the pages; its paths are few rows.
    judged = boxes.join(votes, ["host", "path"])
    main = F.col("share") >= WIN_SHARE
    choice = judged.groupBy("page_id").agg(
        F.max(F.when(main, F.struct("share", "score", "cid")))["cid"].alias("chosen"),
        F.collect_list(F.when(~main, F.col("cid"))).alias("losers"),
    )
    # Pages meet their choice whole, so what is shuffled are their runs' hashes in one row.
    runs = parsed.select("page_id", "runs").join(choice, "page_id", "left").select("page_id", "chosen", "losers", F.explode("runs").alias("r")).select("page_id", "chosen", "losers", "r.*")
    at = F.array_position("within", F.col("chosen"))
    nested = F.slice("within", (at + 1).cast("int"), F.size("within"))
    inside = F.coalesce((at > 0) & ~F.arrays_overlap(nested, F.col("losers")), F.lit(False))
    placed = cut(runs.where(F.size("within") > 0).select("page_id", "run_no", "heading", *VOTED, inside.alias("inside")))

    def voted_out(hashed: str) -> DataFrame:
        seen = placed.where(F.col(hashed).isNotNull() & ~F.col("heading")).groupBy(hashed, "page_id").agg(F.max((~F.col("inside")).cast("int")).alias("out"))
        counted = seen.groupBy(hashed).agg(F.sum("out").alias("n_out"), F.count("*").alias("n"))
        return counted.where((F.col("n_out") >= OUT_PAGES) & (F.col("n_out") >= OUT_SHARE * F.col("n"))).select(hashed, F.lit(True).alias(f"bad_{hashed}"))

    kept = placed.where("inside")
    for hashed in VOTED:
        kept = kept.join(voted_out(hashed), hashed, "left")
    bad = " or ".join(f"bad_{hashed} is not null" for hashed in VOTED)
    return kept.where(f"heading or not ({bad})").select("page_id", "run_no")


def main_runs(pages: DataFrame) -> DataFrame:
    """(page_id, run_no) of the runs of main text, in any order."""
    return _main(cut(analysed_pages(pages, texts=False)))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, text): the main runs of each page in order, one per line."""
    parsed = cut(analysed_pages(pages))
    kept = _main(parsed).groupBy("page_id").agg(F.array_sort(F.collect_list("run_no")).alias("kept"))
    runs = parsed.select("page_id", "runs").join(kept, "page_id")
    # Runs count from 0 without gaps.
    return runs.select("page_id", F.array_join(F.transform("kept", lambda i: F.trim(F.get("runs", i)["text"])), "\n").alias("text"))
