"""Secret scans [native] with corpus-wide ownership frequency.

Candidates are found by patterns in every whole text, in one pass. Their hashes are then counted
over distinct owners and distinct repositories: a candidate that many owners hold in many
repositories is a copied example, one that belongs to few is live-looking. Equal (hash, owner)
and (hash, repository) rows are combined before they move, so a candidate that stands in a third
of all texts is summed map-side, and rows of a hash or set of hashes that very many share are
judged where they are.

Defined cases: a null text is scanned as an empty one; a text without candidates has empty
arrays; very long texts are scanned whole, in time linear in their length; of spans that start
together the kind listed first comes first, and spans of different kinds may overlap; equal rows
get equal results; an empty table gives no rows; owners or repositories that are null count as
one owner or repository, as an empty one does; columns that bear the name of an output column
are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm.common import Kept, Scratch, documents, join_spread

#: Base kinds in their fixed order: pattern, group with the value, least length of the group.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
#: Kinds that this method adds: key blocks and signed web tokens.
ADDED = {
    "pem": (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
}
#: A key block from its first line to its END line or, where that is cut off, to the end of the base64 lines; the
#: group is the body. Possessive throughout, so a scan is linear and needs no stack. Its kind is that of the header in ADDED.
_END, _GAP = r"-----END [A-Z ]{0,30}PRIVATE KEY-----", r"(?:\s|\\[nr])"
KEY_BLOCK = (
    ADDED["pem"][0] + rf"([^-]*+(?:-{{1,4}}+[^-]++)*+(?={_END})"
    rf"|(?:{_GAP}*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+={{0,2}}+)*+(?:{_GAP}++[A-Za-z0-9+/]{{1,15}}+={{1,2}}+)?+)(?:{_END})?+"
)
#: A candidate held by at least this many owners is a copied example.
COPIED_OWNERS = 3
#: Provided that these stand in at least so many repositories: copies of one repository are one leak.
COPIED_REPOSITORIES = 3
MADE = ("secret_spans", "live_hashes", "max_owners", "max_repositories")
SPAN = "array<struct<kind:string,start:int,end:int,hash:string>>"


def _kind_spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of the leftmost non-overlapping matches, in code points, end exclusive.

    The pieces between matches (split) and the matches (extract all) alternate, so running
    sums of their lengths give every position.
    """
    p = F.lit(pattern)
    found = F.arrays_zip(F.regexp_extract_all(text, p, F.lit(0)).alias("m"), F.regexp_extract_all(text, p, F.lit(group)).alias("v"), F.split(text, pattern, -1).alias("gap"))
    empty = F.expr(f"named_struct('at', 0, 'spans', cast(array() as {SPAN}))")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        value = x["v"]
        if kind == "pem":  # the body however its lines are broken; a header alone stands for itself
            body = F.regexp_replace(value, _GAP, "")
            value = F.when(F.length(body) > 0, body).otherwise(x["m"])
        span = F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), F.sha2(value, 256).alias("hash"))).cast(SPAN)
        keep = x["m"].isNotNull() & (F.length(x["v"]) >= least)
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    none = F.expr(f"cast(array() as {SPAN})")
    return F.when(text.rlike(pattern), F.aggregate(found, empty, step, lambda acc: acc["spans"])).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``secret_spans``: all spans by start, then kind as listed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = {**BASE, **ADDED, "pem": (KEY_BLOCK, 1, 0)}
    every = F.concat(*[_kind_spans(text, k, *v) for k, v in kinds.items()])
    def rank(kind: Column) -> Column:
        out = F.when(kind == F.lit(next(iter(kinds))), 0)
        for i, k in enumerate(kinds):
            out = out.when(kind == F.lit(k), i) if i else out
        return out

    def order(a: Column, b: Column) -> Column:
        x, y = a["start"] * 8 + rank(a["kind"]), b["start"] * 8 + rank(b["kind"])
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    return docs.withColumn("secret_spans", F.when(F.size(every) > 0, F.array_sort(every, order)).otherwise(every))


def _hashes(spans: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["hash"])))


def ownership(scanned: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per candidate hash: ``hash, n_owners, n_repositories``, both distinct."""
    def both(h: Column) -> Column:
        return F.array(F.struct(h.alias("hash"), F.lit(True).alias("owner"), owner.alias("name")), F.struct(h.alias("hash"), F.lit(False).alias("owner"), repository.alias("name")))

    rows = scanned.select(F.explode(F.flatten(F.transform(_hashes(F.col("secret_spans")), both))).alias("of"))
    each = rows.select("of.hash", "of.owner", "of.name").distinct()
    return each.groupBy("hash").agg(F.sum(F.col("owner").cast("int")).alias("n_owners"), F.sum((~F.col("owner")).cast("int")).alias("n_repositories"))


def find_secrets(docs: DataFrame, owner: Column | None = None, repository: Column | None = None, copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES, with_text: bool = True) -> DataFrame:
    """``docs`` with ``secret_spans``, ``live_hashes`` (hashes of owner-specific candidates) and the most owners and
    repositories of a candidate, ``max_owners, max_repositories`` (0 without any).

    By default the owner is the source, and a repository is the part of a source in one language. Without ``with_text``
    the text is left out, so that what is written between scan and verdict is small.
    """
    owner = F.coalesce("source", F.lit("")) if owner is None else owner
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))) if repository is None else repository
    kept, scratch = Kept(docs, "text", owner=owner, repository=repository), Scratch(docs.sparkSession, "secrets")
    signature = F.sha2(F.array_join(_hashes(F.col("secret_spans")), ","), 256)
    scanned = scan(kept.frame)
    # every text is scanned once: what was found is written down with the rows
    scanned = scratch.save((scanned if with_text else scanned.drop("text")).withColumn("signature", signature), "scanned")
    hits = scanned.where(F.size("secret_spans") > 0)
    owned = scratch.save(ownership(hits, F.col("owner"), F.col("repository")), "owned")
    # one row per distinct set of candidates, so equal sets are judged once
    sets = scratch.save(hits.select("signature", _hashes(F.col("secret_spans")).alias("h")).distinct().select("signature", F.explode("h").alias("hash")), "sets")
    live = F.when((F.col("n_owners") < copied_owners) | (F.col("n_repositories") < copied_repositories), F.col("hash"))
    judged = join_spread(sets, owned, "hash", scratch).groupBy("signature").agg(
        F.array_sort(F.collect_set(live)).alias("live_hashes"), F.max("n_owners").alias("max_owners"), F.max("n_repositories").alias("max_repositories")
    )
    none = scanned.where(F.size("secret_spans") == 0).withColumns({"live_hashes": F.expr("cast(array() as array<string>)"), "max_owners": F.lit(0).cast("long"), "max_repositories": F.lit(0).cast("long")})
    every = join_spread(hits, scratch.save(judged, "judged"), "signature", scratch).unionByName(none)
    return kept.back(every, *MADE, without=() if with_text else ("text",))


def redact(found: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """Replace each live-looking span of ``text`` by ``mask``; copied examples stay."""
    live = F.filter("secret_spans", lambda s: F.array_contains(F.col("live_hashes"), s["hash"]))
    start = F.expr("named_struct('at', 0, 'text', '')")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["text"], gap, F.lit(mask))).otherwise(acc["text"]).alias("text"),
        )

    clean = F.aggregate(live, start, step, lambda acc: F.concat(acc["text"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return found.withColumn("text", F.when(F.size(live) > 0, clean).otherwise(F.col("text")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir).select("doc_id", "text", "source", "lang"), with_text=False)
    spans = F.col("secret_spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    live = F.filter(spans, lambda s: F.array_contains(F.col("live_hashes"), s["hash"]))
    return found.select("doc_id", *map(count, BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"), F.size(live).cast("long").alias("n_live"), "max_owners", "max_repositories")
