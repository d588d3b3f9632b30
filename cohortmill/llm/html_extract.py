"""HTML extraction by the long substrings that distinct pages of a host share.

Every page is read once into blocks of text with the part of the page they stand in: the article (``article`` or ``main``
outside any page furniture), furniture (menus, headers, footers, sidebars, notices, adverts, forms, comments, by element,
role, or class and id words), or neither. The token streams of all pages, articles and furniture included, are searched
for substrings that distinct page contents of the host share. What ``repeated_tokens`` finds in one host's suffix array
is found here for hosts of any size: suffixes of equal rank at depth ``least`` are equal windows of ``least`` tokens, so
hashed windows are dealt by hash and counted over the whole host, and two bits a window come back to the pages. This is
done twice: all windows are dealt with the leading bits of their hashes, enough to tell most of them apart, and whole
hashes only for windows that another page may hold. All steps read one shuffle of the parsed pages, dealt by run.

Unique text is kept wherever it stands outside furniture. Repeated text outside articles is boilerplate. In an article,
markup arbitrates: repeated text stays, except blocks that at least three page contents repeat wholly in an article that
is otherwise mostly its own.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, named, restored, text_runs, word_codes, word_hashes

NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
#: Attributes up to the end of the tag, quoted values whole; possessive, so that a failure is one pass over the rest.
ATTRIBUTES = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
#: Elements whose content is no text of the page, up to their end tag or the end of the page.
RAW = {t: re.compile(rf"</{t}\s*+>", re.IGNORECASE) for t in "script style noscript template textarea title svg iframe".split()}
ATTRIBUTE = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
#: Words in class, id and role that mark page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert alertdialog "
    "sidebar side comment comments disqus reply replies respond menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer "
    "masthead share sharing social related recommended newsletter subscribe subscription popup modal overlay widget login signup search "
    "contentinfo complementary toolbar skip".split()
)
#: Words that name a place or a box beside a furniture word ("site-footer", "related-posts"); with any other word the name is one of content ("social-science").
PLACE_WORDS = frozenset(
    "site page main top bottom left right header head body inner outer wrap wrapper container content block box bar area section row col column slot unit group list item items "
    "link links post posts article articles story stories button buttons icon icons primary secondary global local mobile desktop sticky fixed text title form field policy us".split()
)
FURNITURE_TAGS = frozenset("nav footer aside form button select option label menu dialog head".split())
#: Characters of HTML in a run of pages, and the odd number that mixes the hashes of a window's tokens.
RUN_CHARS = 6_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LIMITS = frozenset("article main body".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br label".split())


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return False
    if HIDDEN.search(attributes):
        return True
    return any(_names_furniture(name) for value in ATTRIBUTE.findall(attributes) for name in value.lower().split())


def _names_furniture(name: str) -> bool:
    """Whether a class, id or role names furniture: a furniture word, alone or with words of place and numbers."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return any(w in FURNITURE_WORDS for w in words) and all(w in FURNITURE_WORDS or w in PLACE_WORDS for w in words)


def pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes), ("close", tag, "") or ("raw", tag, "") of a page, in one pass.

    A comment, and an element of ``RAW``, reach to their end or to that of the page. If quotes do not pair up to the end of
    the page, tags end at the next ``>`` from there on; a ``<`` after the last ``>`` is text. So no stretch of a page is
    searched more than a few times, however malformed it is.
    """
    at, size, paired, last = 0, len(page), True, page.rfind(">")
    while at < size:
        mark = page.find("<", at)
        if mark != at:
            stop = size if mark < 0 else mark
            yield "text", page[at:stop], ""
            at = stop
            continue
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = size if stop < 0 else stop + 3
            continue
        name = NAME.match(page, at) if at < last else None
        if name is None:
            if at < last and page[at + 1 : at + 2] in ("!", "?", "/"):
                at = page.find(">", at) + 1
            else:
                yield "text", "<", ""
                at += 1
            continue
        rest = ATTRIBUTES.match(page, name.end()) if paired else None
        paired = rest is not None
        stop = rest.end() if paired else page.find(">", name.end()) + 1
        attributes, tag = page[name.end() : stop - 1], name[2].lower()
        at = stop
        if name[1]:
            yield "close", tag, ""
        elif tag in RAW and not (tag == "svg" and attributes.endswith("/")):
            end = RAW[tag].search(page, at)
            at = end.end() if end else size
            yield "raw", tag, ""
        else:
            yield "open", tag, attributes


def blocks(page: str) -> list[tuple[int, str]]:
    """(part, text) of the page's blocks in order; part 2: article, 1: neither, 0: furniture. Texts are trimmed, not empty."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements other than inline ones and paragraphs, with the part outside them
    frames: list[Counter] = [Counter()]  # how many of each are open, apart for each stretch between two of LIMITS
    limits: Counter = Counter()  # how many of each are open in all
    part = 1

    def end() -> None:
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                out.append((part, whole))
            text.clear()

    def pop() -> int:
        """Closes the innermost element: the part outside it."""
        tag, outside = stack.pop()
        if tag in LIMITS:
            frames.pop()
        frames[-1][tag] -= 1
        limits[tag] -= 1
        return outside

    for kind, tag, attributes in pieces(page):
        if kind == "text":
            text.append(tag)
        elif kind == "raw":
            if tag not in ("svg", "template"):
                end()
        elif tag in ("br", "wbr", "img"):
            text.append(" " if tag == "br" else "")
        elif kind == "close":
            if tag not in INLINE:
                end()
            # an end tag closes an element inside the innermost article, main or body only, unless it is that of such an element
            if (limits if tag in LIMITS or tag == "html" else frames[-1])[tag] > 0:
                end()
                while stack[-1][0] != tag:
                    pop()
                part = pop()
        else:
            furniture = _is_furniture(tag, attributes, part == 2)
            if tag not in INLINE or furniture:
                end()
            if tag in VOID or attributes.endswith("/"):
                continue
            if (tag not in INLINE and tag != "p") or furniture:
                stack.append((tag, part))
                frames[-1][tag] += 1
                limits[tag] += 1
                if tag in LIMITS:
                    frames.append(Counter())
                if furniture:
                    part = 0
                elif tag in ("article", "main") and part:
                    part = 2
    end()
    return out


def repeated_tokens(pages: list[list[int]], least: int) -> list[np.ndarray]:
    """Per page a mask of the tokens inside any substring of ``least`` tokens or more that distinct pages share.

    A suffix array of the concatenated streams, each closed by a token of its own, sorted by prefix doubling to the
    depth ``least``: suffixes of one rank share that many tokens, and a rank met on two pages covers all its places.
    """
    sizes = np.array([len(p) + 1 for p in pages])
    stream = np.concatenate([np.array([*p, -1 - k], np.int64) for k, p in enumerate(pages)])
    owner = np.repeat(np.arange(len(pages)), sizes)
    rank, depth = np.unique(stream, return_inverse=True)[1], 1
    while depth < least:
        step = min(depth, least - depth)
        after = np.concatenate([rank[step:] + 1, np.zeros(step, np.int64)])
        rank, depth = np.unique(rank * (rank.max() + 2) + after, return_inverse=True)[1], depth + step
    order = np.argsort(rank, kind="stable")
    first = np.flatnonzero(np.diff(rank[order], prepend=-1))
    low, high = np.minimum.reduceat(owner[order], first), np.maximum.reduceat(owner[order], first)
    starts = order[np.repeat(low < high, np.diff(np.append(first, len(order))))]
    edge = np.bincount(starts, minlength=len(stream) + 1) - np.bincount(np.minimum(starts + least, len(stream)), minlength=len(stream) + 1)
    covered = np.cumsum(edge)[: len(stream)] > 0
    return [c[:-1] for c in np.split(covered, np.cumsum(sizes)[:-1])]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of pages: a number, a hash of each page's host and stream, and the pages as packed Arrow data."""
    run = TaskContext.get().partitionId() << 32
    for b in text_runs(batches, "_html", RUN_CHARS):
        parts, streams, keys = [], [], []
        for page, host in zip(b.column("_html"), b.column("_host"), strict=True):
            found = blocks(page.as_py() or "")
            parts.append([p for p, _ in found])
            streams.append("\n".join(t for _, t in found))  # blocks are trimmed to single spaces
            keys.append(xxhash.xxh64_intdigest(f"{host}\n{streams[-1]}".encode("utf-8", "surrogatepass")))
        rest = [c for c in b.schema.names if c != "_html"]
        made = pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(parts, pa.list_(pa.int8())), pa.array(streams, pa.string())], [*rest, "_parts", "_stream"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, made.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(made)
        yield pa.RecordBatch.from_arrays(
            [pa.array([run], pa.int64()), pa.array([np.array(keys, np.uint64).view(np.int64)], pa.list_(pa.int64())), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["run", "keys", "pages"],
        )
        run += 1


def _unpack(blob: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob.as_buffer()).read_next_batch()


def windows(pages: pa.RecordBatch, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, page and first token of every window of ``least`` tokens in a page, and the tokens per page."""
    codes, words, n = word_codes(pages.column("_stream"), lower=False)
    h = word_hashes(words)[codes]
    page = np.repeat(np.arange(len(n)), n)
    many = max(0, len(h) - least + 1)
    out = np.zeros(many, np.uint64)
    for k in range(least):
        out = out * MULTIPLIER + h[k : k + many]
    host = np.array([xxhash.xxh64_intdigest((x.as_py() or "").encode("utf-8", "surrogatepass"), seed=1) for x in pages.column("_host")], np.uint64)
    out = (out ^ host[page[:many]]) * MULTIPLIER
    out ^= out >> np.uint64(32)
    at = np.flatnonzero(page[:many] == page[least - 1 :][:many])
    return out[at], page[at], at, n


def _edges(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each range of hashes ends in the sorted hashes."""
    return np.append(np.searchsorted(distinct, np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets)), len(distinct))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of each page of the runs, and its place."""
    for b in batches:
        keys = b.column("keys")
        n = pc.list_value_length(keys).to_numpy(zero_copy_only=False)
        pos = np.concatenate([np.arange(k) for k in n]) if len(n) else n
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("run").to_numpy(), n)), pa.array(pos, pa.int32()), keys.flatten()], ["run", "pos", "key"])


def _flags(found: pa.Scalar, distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Which of a run's sorted distinct hashes two pages share, and which three, from the bits that came back."""
    flags = np.zeros((2, len(distinct)), bool)
    ends = _edges(distinct, buckets)
    for r in found.as_py() or []:
        low, high = ends[r["bucket"] - 1] if r["bucket"] else 0, ends[r["bucket"]]
        flags[:, low:high] = np.unpackbits(np.frombuffer(r["bits"], np.uint8).reshape(2, -1), axis=1)[:, : high - low]
    return flags


def _leading(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(64 - bits) << np.uint64(64 - bits)


def _candidates(h: np.ndarray, found: pa.Scalar, bits: int, buckets: int) -> np.ndarray:
    """Which windows have leading bits that two pages share."""
    distinct, back = np.unique(_leading(h, bits), return_inverse=True)
    return _flags(found, distinct, buckets)[0][back]


def _pack(distinct: np.ndarray, bits: int) -> list[bytes]:
    """Sorted hashes as the byte planes of their differences, low bytes first, without the planes of zeros alone."""
    step = np.diff(distinct >> np.uint64(64 - bits), prepend=np.uint64(0))
    planes = step.astype("<u8").view(np.uint8).reshape(-1, 8).T
    small = zstandard.ZstdCompressor(level=1)
    return [small.compress(p.tobytes()) for p in planes[: -(-int(step.max()).bit_length() // 8)]]


def _unpack_hashes(planes: list[bytes], n: int) -> np.ndarray:
    whole = np.zeros((n, 8), np.uint8)
    for k, p in enumerate(planes):
        whole[:, k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint8)
    return np.cumsum(whole.view("<u8").ravel(), dtype=np.uint64)


def _deal(batches: Iterator[pa.RecordBatch], least: int, buckets: int, bits: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """A run's distinct windows by range of hashes, with the number of its pages that hold them (3 or more: 3).

    Leading bits of all windows, or whole hashes of the candidates. Only the first page of equal content counts.
    """
    for b in batches:
        for row in range(b.num_rows):
            h, page, _, n = windows(_unpack(b.column("pages")[row]), least)
            if whole:
                chosen = _candidates(h, b.column("maybe")[row], bits, buckets)
                h, page = h[chosen], page[chosen]
            else:
                h = _leading(h, bits)
            first = np.zeros(len(n), bool)
            first[b.column("firsts")[row].as_py() or []] = True
            distinct = np.unique(h)
            own = first[page]
            order = np.lexsort((page[own], h[own]))
            hs, ps = h[own][order], page[own][order]
            new = np.ones(len(hs), bool)
            new[1:] = (hs[1:] != hs[:-1]) | (ps[1:] != ps[:-1])
            count = np.minimum(np.bincount(np.searchsorted(distinct, hs[new]), minlength=len(distinct)), 3).astype(np.uint8)
            rows, at = [], 0
            for k, end in enumerate(_edges(distinct, buckets)):
                if end > at:
                    rows.append((k, b.column("run")[row].as_py(), _pack(distinct[at:end], 64 if whole else bits), count[at:end].tobytes()))
                at = end
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.binary()), strict=True)], ["bucket", "run", "hashes", "counts"])


def _meet(got: pd.DataFrame) -> pd.DataFrame:
    """For a range of hashes: to each run, bits of its windows that two pages share, then of those that three share."""
    ends = np.cumsum([len(x) for x in got["counts"]])
    parts = [_unpack_hashes(list(x), len(c)) for x, c in zip(got["hashes"], got["counts"], strict=True)]
    distinct, at = np.unique(np.concatenate(parts), return_inverse=True)
    count = np.bincount(at, np.frombuffer(b"".join(got["counts"]), np.uint8), len(distinct))[at]
    bits = [np.packbits(c >= 2).tobytes() + np.packbits(c >= 3).tobytes() for c in np.split(count, ends[:-1])]
    return pd.DataFrame({"run": got["run"], "bucket": got["bucket"], "bits": bits})


def _cover(at: np.ndarray, size: int, least: int) -> np.ndarray:
    edge = np.bincount(at, minlength=size + 1) - np.bincount(at + least, minlength=size + 1)
    return np.cumsum(edge)[:size] > 0


def page_text(parts: list[int], texts: list[str], shared: np.ndarray, common: np.ndarray, least: int) -> str:
    """The page's text, given the tokens that two page contents share and those that three share."""
    ends = np.cumsum([t.count(" ") + 1 for t in texts])
    places = [(int(e) - t.count(" ") - 1, int(e)) for e, t in zip(ends, texts, strict=True)]
    repeated = [bool(common[a:b].all()) and b - a >= least for a, b in places]
    article = sum(b - a for (a, b), p in zip(places, parts, strict=True) if p == 2)
    whole = sum(b - a for (a, b), p, r in zip(places, parts, repeated, strict=True) if p == 2 and r)
    kept = []
    for part, text, (a, b), again in zip(parts, texts, places, repeated, strict=True):
        if part == 2:
            if not again or 2 * whole > article:
                kept.append(text)
        elif part:
            own = shared[a:b].copy()
            if own.any() and not own.all():  # a run that began in the block before counts here only if it is long enough by itself
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                for i, j in zip(edge[::2], edge[1::2], strict=True):
                    own[i:j] = j - i >= least
            run = " ".join(w for w, c in zip(text.split(" "), own, strict=True) if not c)
            if run:
                kept.append(run)
    return "\n\n".join(kept)


def _texts(batches: Iterator[pa.RecordBatch], least: int, buckets: int, bits: int, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for maybe, found, blob in zip(b.column("maybe"), b.column("found"), b.column("pages"), strict=True):
            pages = _unpack(blob)
            h, _, at, n = windows(pages, least)
            chosen = _candidates(h, maybe, bits, buckets)
            distinct, back = np.unique(h[chosen], return_inverse=True)
            shared, common = (_cover(at[chosen][f[back]], int(n.sum()), least) for f in _flags(found, distinct, buckets))
            out, stop = [], np.cumsum(n)
            for parts, stream, e, m in zip(pages.column("_parts"), pages.column("_stream"), stop, n, strict=True):
                texts = stream.as_py().split("\n") if m else []
                out.append(page_text(parts.as_py(), texts, shared[e - m : e], common[e - m : e], least))
            yield pa.RecordBatch.from_arrays([*(pages.column(c) for c in keep), pa.array(out, pa.string())], [*keep, "text"])


def extract_pages(pages: DataFrame, *, html_column: str = "html", url: str = "url", keep: tuple[str, ...] = ("page_id", "url"), least: int = 6, bucket_chars: int = 24_000_000) -> DataFrame:
    """``keep`` columns, ``text`` (blocks joined by an empty line, empty if there are none) and ``n_chars``.

    Null and empty pages give an empty text; a null or odd URL is a host of its own. Pages of a host with the same words
    count as one page, so repeated rows, and an article under two URLs, give repeated results; an empty table gives no
    rows. A kept column named like a result gives way to it. A task holds one run of pages (``RUN_CHARS`` characters or one
    page) or the hashed windows of ``bucket_chars`` characters of HTML. Runs are numbered by partition, so the rows of
    ``pages`` must come in the same order if they are read again, as those of stored tables do.
    """
    host = F.coalesce(F.lower(F.regexp_extract(named(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = carried(pages, keep, _host=host, _html=named(html_column))
    chars = rows.agg(F.coalesce(F.sum(F.length("_html")), F.lit(0))).first()[0]
    buckets, bits = max(64, -(-chars // bucket_chars)), min(64, chars.bit_length() + 2)
    # Every use takes all columns and joins from the left, so that nothing is pushed below this shuffle and Spark makes it once.
    parsed = rows.mapInArrow(_parse, "run long, keys array<long>, pages binary").repartition("run")

    first = parsed.mapInArrow(_places, "run long, pos int, key long").groupBy("key").agg(F.min(F.struct("run", "pos")).alias("first"))
    firsts = first.groupBy(F.col("first.run").alias("at")).agg(F.collect_list("first.pos").alias("firsts"))
    keyed = parsed.join(firsts, F.col("run") == F.col("at"), "left").drop("at")

    def shared(runs: DataFrame, name: str, whole: bool) -> DataFrame:
        dealt = runs.mapInArrow(lambda it: _deal(it, least, buckets, bits, whole), "bucket int, run long, hashes array<binary>, counts binary")
        met = dealt.groupBy("bucket").applyInPandas(_meet, "run long, bucket int, bits binary")
        return met.groupBy(F.col("run").alias("at")).agg(F.collect_list(F.struct("bucket", "bits")).alias(name))

    known = keyed.join(shared(keyed, "maybe", False), F.col("run") == F.col("at"), "left").drop("at")
    found = known.join(shared(known, "found", True), F.col("run") == F.col("at"), "left").drop("at")
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name.startswith("_keep")), "text string"])
    names = [f"_keep{k}" for k in range(len(keep))]
    done = found.mapInArrow(lambda it: _texts(it, least, buckets, bits, names), kinds)
    return restored(done.withColumn("n_chars", F.length("text").cast("long")), keep, ("text", "n_chars"))
