"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Regular expressions propose candidates.  Each candidate's hash is counted over the
whole corpus by distinct repositories and owners: a value that many owners carry is a
copied example; one that stays with its owner and looks random is a live-looking
credential.  Base kinds (always reported): assign, access, hex.  Added kinds: github,
slack, google, pem, jwt.

Positions come from the lengths of the pieces between matches (``split`` by the same
expression), in code points.  A null text is empty.  Repeated rows each get a row;
a null repository or owner counts as one of its own.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquia.functions.text import compute_once
from colloquia.llm.common import saved

#: name, expression, group that holds the value, least length of the value.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 39),
    ("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
)
BASE = 3
#: Strings without which a kind cannot match; testing them is cheaper than its regex.
NEEDS = {"access": "AKIA", "github": "gh", "slack": "xox", "google": "AIza", "pem": "-----BEGIN ", "jwt": "eyJ"}
#: A value that more owners than this carry is a copied example.
MAX_OWNERS = 2
_SPAN = "array<struct<start:int,kind:int,end:int,hash:string,random:boolean>>"
#: Matches of one kind that are placed together: a text's cost grows with their number.
BLOCK = 128
#: Hashes above this share of all candidates are looked up in a broadcast.
HOT_HASHES = 1_024
_PLACEHOLDER = r"(?i)example|changeme|placeholder|your[_-]|xxxx|test|dummy|sample|^(.)\1*$"


def _spans(text: Column, number: int) -> Column:
    """All matches of a kind with their positions, those with short values dropped."""
    name, pattern, group, least = KINDS[number]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    triples = F.arrays_zip(whole.alias("0"), value.alias("1"), F.slice(gaps, 1, F.size(whole)).alias("2"))
    # the array is bound once; what a lambda refers to would be computed at every element
    found = F.transform(F.array(triples), lambda t: _placed(t, number, least))[0]
    test = F.contains(text, F.lit(NEEDS[name])) if name in NEEDS else F.lit(True)
    return F.when(test & text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _placed(triples: Column, number: int, least: int) -> Column:
    """Spans of (match, value, gap before it): the place of a match is the sum of all before
    it, kept per block of matches, as an array that grows is copied at every step."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(triples) - 1) / BLOCK).cast("int"))
    part = lambda b: F.slice(triples, b * BLOCK + 1, F.lit(BLOCK))
    sizes = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0), lambda n, x: n + x["2"] + F.length(x["0"])))
    begins = F.aggregate(
        sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"])

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["2"]
        end = begin + F.length(x["0"])
        # the value itself goes no further: its hash, and whether it looks random
        looks = x["1"].rlike("[0-9]") & x["1"].rlike("[A-Za-z]") & ~x["1"].rlike(_PLACEHOLDER)
        span = F.array(F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("end"),
                                F.sha2(x["1"], 256).alias("hash"), looks.alias("random")))
        return F.struct(end.alias("at"),
                        F.when(F.length(x["1"]) >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def spans(b: Column, begin: Column) -> Column:
        return F.aggregate(part(b), F.struct(begin.alias("at"), F.array().cast(_SPAN).alias("out")), step, lambda acc: acc["out"])

    return F.flatten(F.zip_with(blocks, begins, spans))


def candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``spans``: every candidate of a row by start, then kind."""
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    per_kind = [_spans(F.col("__text"), i) for i in range(len(KINDS))]
    return compute_once(rows, keep, spans=F.array_sort(F.concat(*per_kind)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: distinct repositories and owners, and the verdict.

    ``found`` has the columns ``hash, repo, owner, random``.  A hot value shrinks to
    one row per repository and task before it is shuffled."""
    seen = found.groupBy("hash", "owner", "repo").agg(F.max("random").alias("random"), F.count(F.lit(1)).alias("n"))
    seen = seen.groupBy("hash", "owner").agg(F.max("random").alias("random"), F.sum("n").alias("n"),
                                             F.count(F.lit(1)).alias("repos"))
    by_hash = seen.groupBy("hash").agg(F.max("random").alias("random"), F.sum("n").alias("n_places"),
                                       F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    return by_hash.select("hash", "n_places", "n_repos", "n_owners",
                          F.when(F.col("n_owners") > MAX_OWNERS, "example").when(F.col("random"), "live")
                          .otherwise("weak").alias("verdict"))


def scan(docs: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """Counts, spans and ownership verdicts per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), repo.cast("string").alias("repo"),
                       owner.cast("string").alias("owner"), "text")
    rows = saved(candidates(rows, ["doc_id", "repo", "owner"])
                 .withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    each = rows.select("row", "repo", "owner", F.explode("spans").alias("s")).select(
        "row", "repo", "owner", "s.hash", "s.random")
    verdicts = saved(ownership(each), "secret-verdicts")
    total = verdicts.agg(F.sum("n_places")).first()[0] or 0
    hot = F.col("n_places") * HOT_HASHES >= total   # at most HOT_HASHES rows
    near = F.broadcast(verdicts.where(hot).select("hash", "verdict"))
    judged = each.join(near, "hash").select("row", "verdict").unionByName(
        each.join(F.broadcast(verdicts.where(hot).select("hash")), "hash", "left_anti")
        .join(verdicts.where(~hot).select("hash", "verdict"), "hash").select("row", "verdict"))
    per_row = judged.groupBy("row").agg(
        *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "example", "weak")])
    base = F.filter("spans", lambda s: s["kind"] < BASE)
    n_of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    out = rows.join(per_row, "row", "left")
    return out.select(
        "doc_id", *[n_of(k).alias(f"n_{KINDS[k][0]}") for k in range(BASE)],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        *[F.coalesce(f"n_{v}", F.lit(0)).alias(f"n_{v}") for v in ("live", "example", "weak")])
