"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence are multiplied into one posterior per page:
* the text's likelihood under character trigram models, one per language, counted over
  all labelled documents (trigrams are hashed to a fixed number of slots);
* the language that the markup declares, with P(declared | language) counted over pages;
* the address suffix, with P(suffix | language) counted likewise;
* a prior from the page's place on the web, smoothed along global, registered domain,
  host, host and first path segment.
The counts of the last three are sums of the pages' text posteriors by group
(Spark aggregations with a map-side step, so a hot host shrinks before it is shuffled),
and each page's own share is taken out before it is used.

A null or empty page has no text evidence; a null address has the empty host, domain and
suffix.  Pages are judged each, repeated rows too.  Documents with a null language or
without text teach nothing; with no such document the language is null and the posterior
zero.  Ties go to the language first in the alphabet.  Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, prepare, saved

SLOTS = 1 << 14
MAX_LANGUAGES = 512
#: Trigrams overlap threefold, so their evidence is not independent.
TEMPER = 1 / 3
#: Pseudo-counts: trigram slots, levels of the host prior, declared languages, suffixes.
SLOT_ALPHA, PRIOR_ALPHA, DECLARED_ALPHA, SUFFIX_ALPHA = 0.5, 5.0, 20.0, 20.0
DECLARED_TRUST = 0.9

_SKIP = frozenset("script style nav header footer aside template noscript".split())
_TAG = re.compile(r"<!--|<(/?)([A-Za-z][A-Za-z0-9]*)[^<>]*>")
#: Script and style run to the end of the page if they are not closed, layout does not.
_CLOSING = {x: re.compile(rf"</{x}(?![A-Za-z0-9])[^<>]*>", re.I | re.A) for x in _SKIP - {"script", "style"}}
_DECLARED = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)
LEVELS = ("section", "host", "domain")


def visible_text(page: str) -> str:
    """The text outside tags, comments and the elements in _SKIP, in one pass.  A script, a
    style or a comment that is never closed ends the text; the tag of any other element
    that has no closing tag behind it is passed over like other tags."""
    out, at, skip, n = [], 0, "", len(page)
    unclosed: set[str] = set()  # no closing tag from here on: each is searched for once
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            if not skip:
                out.append(page[at:])
            break
        if not skip:
            out += [page[at:m.start()], " "]
        at = m.end()
        if m[2] is None:
            if not skip:
                at = page.find("-->", at)
                if at < 0:
                    break
                at += 3
        elif skip:
            skip = "" if m[1] and m[2].lower() == skip else skip
        elif not m[1] and m[2].lower() in _SKIP - unclosed:
            skip = m[2].lower()
            if skip in _CLOSING and not _CLOSING[skip].search(page, at):
                unclosed.add(skip)
                skip = ""
    return entities.unescape("".join(out))


def slots_of(text: str) -> np.ndarray:
    """How often each slot occurs among the text's character trigrams."""
    code = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    if len(code) < 3:
        return np.zeros(SLOTS, np.int64)
    h = code[:-2] * np.uint64(0x9E3779B1) ^ code[1:-1] * np.uint64(0x85EBCA77) ^ code[2:] * np.uint64(0xC2B2AE3D)
    return np.bincount(((h ^ (h >> np.uint64(17))) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)


def place_of(url: str) -> tuple[str, str, str, str]:
    """(host and first path segment, host, registered domain, suffix).  The registered
    domain is taken as the last two labels, the suffix as the last."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
        first = parts.path.lstrip("/").split("/")[0]
    except ValueError:  # not an address
        return "", "", "", ""
    labels = host.split(".")
    return f"{host}/{first}", host, ".".join(labels[-2:]), labels[-1]


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each slot under each."""
    prepare(docs.sparkSession)
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches(parts):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                if lang not in counts:
                    counts[lang] = np.zeros(SLOTS, np.int64)
                counts[lang] += slots_of(text.as_py())
        for lang, c in counts.items():
            used = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used),
                                              pa.array(c[used])], ["lang", "slot", "n"])

    counted = saved(labelled.mapInArrow(run, "lang string, slot long, n long")
                    .groupBy("lang", "slot").agg(F.sum("n").alias("n")), "trigrams")
    langs = [r["lang"] for r in counted.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((len(langs), SLOTS), SLOT_ALPHA)
    for r in counted.toLocalIterator():  # at most languages x slots short rows
        table[langs.index(r["lang"]), r["slot"]] += r["n"]
    return langs, np.log(table / table.sum(1, keepdims=True)) if langs else table


def posterior(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def read_pages(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """Per page: its place, declared language and the text's log likelihoods."""
    prepare(pages.sparkSession)
    weights = np.ascontiguousarray(model.T)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            places, declared, logs = [], [], []
            for url, page in zip(b.column(1).to_pylist(), b.column(2)):
                page = page.as_py() or ""
                places.append(place_of(url or ""))
                said = _DECLARED.search(page)
                said = said[1].lower() if said else ""
                declared.append(said if said in langs or not said else "other")
                logs.append((slots_of(visible_text(page)) @ weights * TEMPER).tolist())
            section, host, domain, suffix = zip(*places)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.string()) for x in (section, host, domain, suffix, declared)),
                 pa.array(logs, pa.list_(pa.float64())),
                 pa.array(posterior(np.array(logs)).tolist(), pa.list_(pa.float64()))],
                ["page_id", "section", "host", "domain", "suffix", "declared", "logs", "text_p"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, section string, host string, domain string, suffix string, declared string, "
             "logs array<double>, text_p array<double>")


def fuse(logs: np.ndarray, own: np.ndarray, glob: np.ndarray, levels: list[np.ndarray], declared: np.ndarray,
         declared_prior: np.ndarray, suffix: np.ndarray, suffix_prior: np.ndarray) -> np.ndarray:
    """Posterior of each page (rows).  ``own`` are the text posteriors; all counts still
    include them.  ``levels`` go from the widest to the narrowest group."""
    rest = np.maximum(glob - own, 0)
    n = rest.shape[1]
    prior = (rest + 1) / (rest.sum(1, keepdims=True) + n)
    total = rest
    for counts in levels:
        c = np.maximum(counts - own, 0)
        prior = (c + PRIOR_ALPHA * prior) / (c.sum(1, keepdims=True) + PRIOR_ALPHA)
    out = logs + np.log(prior)
    for counts, expected, alpha in ((declared, declared_prior, DECLARED_ALPHA), (suffix, suffix_prior, SUFFIX_ALPHA)):
        c = np.maximum(counts - own, 0)
        out += np.log((c + alpha * expected) / (total + alpha))
    return posterior(out)


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, posterior, and the pieces of evidence, per row of ``pages``."""
    langs, model = train(docs)
    k = len(langs)
    if not k:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), F.lit(None).cast("string").alias("lang"),
                            F.lit(0.0).alias("posterior"), F.lit(None).cast("string").alias("text_lang"),
                            F.lit("").alias("declared"), F.lit("").alias("suffix"), F.lit("").alias("host"))
    rows = saved(read_pages(pages, langs, model), "page-evidence")
    sums = F.array(*[F.sum(F.get("text_p", F.lit(i))) for i in range(k)])
    whole = rows.agg(sums.alias("s")).first()["s"]
    glob = np.array([x or 0.0 for x in whole])
    said = {r["declared"]: r["s"] for r in rows.groupBy("declared").agg(sums.alias("s")).collect()}  # <= k + 2 rows
    declared = np.array([said.get(x, [0.0] * k) for x in [*langs, "other", ""]])
    out = rows
    for level in ("suffix", *LEVELS):
        out = out.join(rows.groupBy(level).agg(sums.alias(f"n_{level}")), level)
    trust = np.where(np.eye(k, dtype=bool), DECLARED_TRUST, (1 - DECLARED_TRUST) / (k + 1))
    expected = np.vstack([trust, np.full((2, k), (1 - DECLARED_TRUST) / (k + 1))])
    n_pages = max(1.0, float(glob.sum()))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            col = lambda name: b.column(b.schema.get_field_index(name))
            arr = lambda name: np.array(col(name).to_pylist(), np.float64)
            own = arr("text_p")
            which = [langs.index(x) if x in langs else k + (x == "") for x in col("declared").to_pylist()]
            suffix = arr("n_suffix")
            p = fuse(arr("logs"), own, glob, [arr(f"n_{x}") for x in reversed(LEVELS)], declared[which],
                     expected[which], suffix, (suffix - own).clip(0).sum(1, keepdims=True) / n_pages + 1e-9)
            yield pa.RecordBatch.from_arrays(
                [col("page_id"), pa.array([langs[i] for i in p.argmax(1)]), pa.array(p.max(1)),
                 pa.array([langs[i] for i in own.argmax(1)]), col("declared"), col("suffix"), col("host")],
                ["page_id", "lang", "posterior", "text_lang", "declared", "suffix", "host"])

    return out.mapInArrow(run, "page_id long, lang string, posterior double, text_lang string, declared string, "
                               "suffix string, host string")
