"""Language of web pages by Bayesian fusion of evidence.

Three kinds of evidence are multiplied for every language:

* the likelihood of the visible text: byte trigrams, hashed to ``BUCKETS``, under each language's
  frequencies. Neighbouring trigrams are not independent, so a long text counts as ``EVIDENCE``
  trigrams of its average likelihood;
* the declared markup language: how often pages whose text is in a language declare it;
* the address: the shares of languages on the page's host, smoothed towards those of its domain
  (the last two labels), these towards those of its suffix (the last label), and these towards all
  pages. A level with few pages leans on the one above (``LEAN`` pages' worth). A page's own
  contribution is taken out of the levels it is judged by.

Shares and declarations are sums over all pages of the probabilities that text alone gives.
Trigram frequencies are learnt from about ``TRAIN_ROWS`` labelled documents of each language, chosen by
hash; a language with fewer is read whole.

A page without text, address or declaration is judged by the rest, in the end by the shares of all
pages; ties go to the language first in alphabetical order. Null html and url count as empty.
Repeated rows are judged each by itself. An empty table gives no rows; without labelled documents
the language is null. Only page_id, url, html, and doc_id, text, lang are read.
"""

from __future__ import annotations

import html as markup
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import byte_view, prepare, slices
from riskweave.session import materialise

BUCKETS = 1 << 14
EVIDENCE = 60.0
LEAN = 10.0
SMOOTHING = 0.5
#: Documents of a language that its trigrams are counted on, about.
TRAIN_ROWS = 4_000
UNSEEN = ("script", "style", "noscript", "template")


def visible(page: str) -> str:
    """Text outside tags, comments, scripts and styles, in one pass."""
    out, until = [], ""
    for k, part in enumerate(page.split("<")):
        if not k:
            out.append(part)
            continue
        lower = part[:12].lower()
        if until:
            if until == "!--":
                at = part.find("-->")
                if at >= 0:
                    until = ""
                    out.append(part[at + 3 :])
            elif lower.startswith("/" + until):
                until = ""
                out.append(part.partition(">")[2])
            continue
        if lower.startswith("!--"):
            at = part.find("-->", 3)
            if at < 0:
                until = "!--"
            else:
                out.append(part[at + 3 :])
            continue
        name = next((n for n in UNSEEN if lower.startswith(n) and not lower[len(n) : len(n) + 1].isalnum()), "")
        tag, _, rest = part.partition(">")
        if name and not tag.endswith("/"):
            until = name
        else:
            out.append(rest)
    return markup.unescape(" ".join(out)).lower()


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashed byte trigrams) of texts."""
    bounds, data = byte_view(column)
    x = data.astype(np.uint32)
    keys = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:] if len(x) > 2 else x[:0]
    keys = (keys * np.uint32(2_654_435_761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    whole = np.ones(len(keys), bool)
    for back in (1, 2):  # a trigram may not reach into the next text
        at = bounds - back
        whole[at[(at >= 0) & (at < len(keys))]] = False
    # Texts shorter than a trigram hold none.
    kept = np.concatenate(([0], np.cumsum(whole)))
    return kept[np.minimum(bounds, len(keys))], keys[whole]


def frequencies(docs: DataFrame, limit: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Log frequency of each bucket, by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=4 << 20):
            low = pa.array([(t or "").lower() for t in batch["text"].to_pylist()])
            offsets, keys = trigrams(low)
            names = np.array(batch["lang"].to_pylist())
            for name in np.unique(names):
                own = np.repeat(names == name, np.diff(offsets))
                counts = np.bincount(keys[own], minlength=BUCKETS)
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([str(name)] * len(used)), "bucket": pa.array(used), "n": pa.array(counts[used])
                })

    docs = docs.select("doc_id", "text", "lang").filter("lang is not null")
    sizes = docs.groupBy("lang").agg(F.count("*").alias("size"))  # a row a language
    # Each language has its own sample, so a rare one is whole where a common one is drawn from.
    share = F.lit(float(limit)) / F.col("size")
    coin = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.join(F.broadcast(sizes), "lang").filter(coin < share)
    rows = rows.select("text", "lang").mapInArrow(run, "lang string, bucket long, n long")
    tables: dict[str, np.ndarray] = {}
    for r in rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket and language
        tables.setdefault(r.lang, np.zeros(BUCKETS))[r.bucket] = r.n
    return {
        name: np.log((t + SMOOTHING) / (t.sum() + SMOOTHING * BUCKETS)) for name, t in sorted(tables.items())
    }


def text_evidence(pages: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``pages`` with ``n`` trigrams and ``t0, t1, ..``, the text's log likelihood in each language."""
    names = list(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", size=4 << 20):
            texts = pa.array([visible(p or "") for p in batch["html"].to_pylist()], pa.string())
            offsets, keys = trigrams(texts)
            n = np.diff(offsets)
            weight = np.minimum(n, EVIDENCE) / np.maximum(n, 1)
            columns = {c: batch[c] for c in ("page_id", "url", "declared")}
            for k, name in enumerate(names):
                sums = np.concatenate(([0.0], np.cumsum(model[name][keys])))
                columns[f"t{k}"] = pa.array((sums[offsets[1:]] - sums[offsets[:-1]]) * weight)
            yield pa.RecordBatch.from_pydict(columns)

    schema = "page_id long, url string, declared string, " + ", ".join(f"t{k} double" for k in range(len(names)))
    return pages.mapInArrow(run, schema)


def declared_language(html: Column) -> Column:
    """The primary language tag that a page declares, null if none."""
    tag = F.regexp_extract(html, r"""(?i)<html\b[^>]{0,2000}?\blang\s{0,9}=\s{0,9}["']?([a-z]{2,3})\b""", 1)
    return F.when(tag != "", F.lower(tag))


def shares(logs: list[Column]) -> list[Column]:
    """Probabilities from log weights."""
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    weights = [F.exp(x - top) for x in logs]
    return [w / sum(weights[1:], weights[0]) for w in weights]


def identify(pages: DataFrame, docs: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(page_id, host, declared, text_lang, lang, probability) of every page."""
    prepare(pages.sparkSession)
    model = frequencies(docs, limit)
    langs = list(model)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = rows.withColumn("declared", declared_language(F.col("html")))
    rows = text_evidence(rows, model) if langs else rows.drop("html")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    rows = rows.withColumn("host", F.when(host != "", host)).withColumn("domain", F.substring_index("host", ".", -2))
    rows = rows.withColumn("suffix", F.substring_index("host", ".", -1)).drop("url")
    if not langs:
        none = F.lit(None).cast("string")
        return rows.select("page_id", "host", "declared", none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("probability"))
    ks = range(len(langs))
    text = shares([F.col(f"t{k}") for k in ks])
    rows = materialise(rows.select("*", *(p.alias(f"p{k}") for k, p in zip(ks, text, strict=True))))

    def sums(name: str) -> list[Column]:
        return [F.sum(f"p{k}").alias(f"{name}{k}") for k in ks]

    totals = rows.agg(*sums("all")).first()
    total = [totals[k] or 0.0 for k in ks]
    judged = rows
    for level in ("suffix", "domain", "host", "declared"):
        table = materialise(rows.filter(F.col(level).isNotNull()).groupBy(level).agg(*sums(level)))
        judged = judged.join(table, level, "left")
    # Shares of languages, from all pages down to the host; a page's own share is taken out.
    everywhere = sum(total)
    prior = [F.lit((total[k] + 1.0) / (everywhere + len(langs))) for k in ks]
    for level in ("suffix", "domain", "host"):
        own = [F.greatest(F.coalesce(F.col(f"{level}{k}") - F.col(f"p{k}"), F.lit(0.0)), F.lit(0.0)) for k in ks]
        size = sum(own[1:], own[0])
        prior = [(own[k] + LEAN * prior[k]) / (size + LEAN) for k in ks]
        judged = judged.select("*", *(prior[k].alias(f"{level}_share{k}") for k in ks))
        prior = [F.col(f"{level}_share{k}") for k in ks]
    # How often pages in a language declare what this page declares.
    said = [
        F.greatest(F.coalesce(F.col(f"declared{k}") - F.col(f"p{k}"), F.lit(0.0)), F.lit(0.0)) + SMOOTHING for k in ks
    ]
    said = [F.when(F.col("declared").isNotNull(), said[k] / (total[k] + LEAN)).otherwise(1.0) for k in ks]
    judged = judged.select(
        "page_id", "host", "declared", *(f"p{k}" for k in ks),
        *((F.col(f"t{k}") + F.log(prior[k]) + F.log(said[k])).alias(f"f{k}") for k in ks),
    )
    fused = shares([F.col(f"f{k}") for k in ks])
    judged = judged.select("*", *(p.alias(f"q{k}") for k, p in zip(ks, fused, strict=True)))

    def best(name: str) -> Column:
        top = F.greatest(*(F.col(f"{name}{k}") for k in ks)) if len(langs) > 1 else F.col(f"{name}0")
        return F.coalesce(*(F.when(F.col(f"{name}{k}") == top, F.lit(langs[k])) for k in ks))

    top = F.greatest(*(F.col(f"q{k}") for k in ks)) if len(langs) > 1 else F.col("q0")
    return judged.select(
        "page_id", "host", "declared", best("p").alias("text_lang"), best("q").alias("lang"), top.alias("probability")
    )
