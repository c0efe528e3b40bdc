"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: a block is *good* or *bad* by its place (menus, headers,
footers, forms, adverts and the like are bad), its link density, and its length and stop-word density; a short block, or
a long one that the densities don't settle, stays *open*. Second pass: an open block takes the label of the nearest
decided block of its own section (article, main, or the rest of the body), good on a tie between unequal labels. Where no block of a page has enough stop words, as in languages without a list, long
blocks of few links are good. In a section without a decided block, open blocks are good inside article or main, else bad.
Pages are independent; each is read once, where it lies.
"""

import html
import re

import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.textpack import slices

# Elements by kind.
RAW = "script|style|noscript|template|textarea|title|iframe"
FOREIGN = frozenset(["svg", "math"])
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5
h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption head""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SIDE = frozenset("nav footer aside form menu dialog head button search".split())
MAIN = frozenset(["article", "main"])
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
SIDE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb
breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe signup login share sharing
social related recommended comment comments disqus replies respond widget toolbar pagination pager copyright disclaimer""".split())
# Words that only say what kind of box a name stands for.
BOX_NAMES = frozenset("""area bar block bottom box button buttons container content form group holder icons inner item items left link links list panel right section
slot text title top unit wrap wrapper""".split())
# Frequent words of English, French, German and Spanish.
STOP = frozenset("""a an and are as at be by for from has have he her his i in is it its not of on or she that the their there they this to was we were which
will with you au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui ma mais ne nous on ou par pas pour qu que qui sa se ses son sur un
une vous aber als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist man mit nach nicht noch nur oder
sich sie sind so über um und uns von vor war wie wir zu zum zur al como con del el ella en era es esta este ha hay las lo los más mi muy no nos o para pero
por si sin su sus te todo y ya""".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(?P<raw>" + RAW + r")(?=[\s/>])(?P<start>[^>]*>)(?:.*?</(?P=raw)(?=[\s/>]|\Z)[^>]*(?:>|\Z)|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.I | re.S)
ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[^\W\d_]+")

SHORT, LONG, LINKS, LOW, HIGH = 8, 20, 0.5, 0.15, 0.25
GOOD, BAD, OPEN = 1, -1, 0


def is_side_name(value, in_main):
    """Does a class or id name a part beside the article?

    Around the article one word of a compound name is enough; inside it, all its words have to speak of such parts or of
    boxes ("share-box", but not "share-price" or "entry-header").
    """
    words = [w for w in re.split(r"[_-]+", value) if w]
    return not SIDE_NAMES.isdisjoint(words) and (not in_main or all(w in SIDE_NAMES or w in BOX_NAMES for w in words))


def is_side(name, attrs, in_main):
    """Does this element hold no article text?"""
    if name in SIDE or (name == "header" and not in_main):
        return True
    if not attrs or name in ("html", "body"):
        return False
    for key, *values in ATTR.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key == "role" and value in SIDE_ROLES:
            return True
        if key in ("class", "id") and name not in MAIN and any(is_side_name(x, in_main) for x in value.split()):
            return True
    return False


def blocks_of(page):
    """(text, characters inside links, bad by place?, section number, inside article or main?) of each block with text."""
    out, pieces, linked = [], [], 0
    stack, side, main, links, section, foreign = [], 0, 0, 0, 0, 0  # stack: (name, is side, is main)

    def text(raw):
        nonlocal linked
        if raw:
            pieces.append(raw)
            if links:
                linked += len(raw)

    def flush():
        nonlocal linked
        if pieces:
            whole = " ".join("".join(map(html.unescape, pieces)).split())
            if whole:
                out.append((whole, linked, side > 0, section, main > 0))
            pieces.clear()
            linked = 0

    def pop():
        nonlocal side, main, links, section, foreign
        name, was_side, was_main = stack.pop()
        side -= was_side
        main -= was_main
        links -= name == "a"
        foreign -= name in FOREIGN
        section += was_main

    at = 0
    while m := TOKEN.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        if m["raw"] and foreign and m["start"].endswith("/>"):
            at = m.end("start")  # empty inside a drawing or formula
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
        if m["close"] or m["close2"]:
            if any(x[0] == name for x in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
        elif name not in VOID:
            if name in ("p", "li", "a") and stack and any(x[0] == name for x in stack):
                # an element that cannot hold itself ends where the next one starts, unless a container lies between
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        while len(stack) > k:
                            pop()
                        break
                    if stack[k][0] in BLOCK:
                        break
            attrs = m["attrs"] if m["name"] else m["attrs2"]
            if name in BLOCK:
                while foreign:  # a block ends an open drawing or formula
                    pop()
            if attrs.endswith("/") and (foreign or name in FOREIGN):
                continue
            is_main = name in MAIN
            section += is_main
            stack.append((name, is_side(name, attrs, main > 0), is_main))
            side += stack[-1][1]
            main += is_main
            links += name == "a"
            foreign += name in FOREIGN
    text(page[at:])
    flush()
    return out


def labels_of(blocks):
    first = []
    for text, linked, side, _, _ in blocks:
        words = WORD.findall(text.lower())
        density = sum(w in STOP for w in words) / max(1, len(words))
        if side or linked > LINKS * len(text):
            first.append(BAD)
        elif len(words) >= LONG and density >= LOW or len(words) >= SHORT and density >= HIGH:
            first.append(GOOD)
        else:
            first.append(OPEN)
    if GOOD not in first:  # no stop words: a language without a list here, in which length and link density decide
        first = [GOOD if label == OPEN and len(WORD.findall(b[0])) >= LONG else label for b, label in zip(blocks, first)]
    n = len(blocks)
    before, after, seen = [None] * n, [None] * n, {}
    for i in range(n):  # a block that is bad by its place decides nothing about its neighbours
        before[i] = seen.get(blocks[i][3])
        if first[i] != OPEN and not blocks[i][2]:
            seen[blocks[i][3]] = i
    seen = {}
    for i in range(n - 1, -1, -1):
        after[i] = seen.get(blocks[i][3])
        if first[i] != OPEN and not blocks[i][2]:
            seen[blocks[i][3]] = i
    final = list(first)
    for i in range(n):
        if first[i] == OPEN:
            near = [(abs(j - i), -first[j]) for j in (before[i], after[i]) if j is not None]
            final[i] = -min(near)[1] if near else GOOD if blocks[i][4] else BAD
    return final


def extract(page):
    """(main text, blocks, kept blocks) of one page."""
    blocks = blocks_of(page or "")
    kept = [b[0] for b, label in zip(blocks, labels_of(blocks)) if label == GOOD]
    return "\n".join(kept), len(blocks), len(kept)


def task(batches):
    for batch in slices(batches, 4_000_000, "html"):
        found = [extract(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([f[0] for f in found], pa.string()), pa.array([len(f[0]) for f in found], pa.int64()),
                                          pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                                         names=["row", "text", "n_chars", "n_blocks", "n_kept"])


def main_text(pages, html="html"):
    """The other columns of `pages` and: text, n_chars (code points), n_blocks, n_kept.

    Character references are decoded once, white space inside a block becomes one space, blocks are joined by a new
    line. A null or empty page, and one without main text, gives "". Markup that breaks off at the end of the page
    is markup. Scripts, styles, templates and the like end at their closing tag, else at the end of the page; any other element,
    drawings, formulas and players too, ends at the latest with the block around it, and its text counts. Repeated rows give repeated results; an empty table gives an empty one; a column of `pages` with one
    of the new names is replaced.
    """
    common.ship("unitgrid.llm.common", __name__)
    made = ("text", "n_chars", "n_blocks", "n_kept")
    packed = pages.select(common.rest_struct(pages, html, *made).alias("row"), common.quoted(html).alias("html"))
    done = packed.mapInArrow(task, f"row {packed.schema['row'].dataType.simpleString()}, text string, n_chars long, n_blocks long, n_kept long")
    return done.select(*[F.col("row").getField(c).alias(c) for c in common.others(pages, html, *made)], *made)
