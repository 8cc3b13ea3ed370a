"""Secret scans in DataFrame expressions only: pattern matches with positions, and corpus-wide ownership of every candidate.

Positions come from two expressions over one pattern: the matches (regexp_extract_all) and the text between them
(split); their lengths are summed along by doubling, in as many steps as the number of matches has binary digits. Candidates are the base matches and
random-looking strings of general form. Each is hashed and counted over the whole corpus by distinct repositories
and owners: what several owners or many repositories hold is a copied example, what one owner holds and looks
random is a live-looking credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import keep, spread_join, stored

#: Patterns of the base kinds and the least length of what counts (assign: of its second group).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the runs of AKIA[A-Z0-9]+ with 20 characters or more
HEX = r"[0-9a-f]{24,}"  # the maximal runs with 24 characters or more
KINDS = ("assign", "access", "hex", "live")
#: General candidates: runs of 20 or more characters of tokens and keys.
CANDIDATE = r"[A-Za-z0-9+_-]{20,}"
#: A candidate that more distinct owners than this hold, or more distinct repositories, is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 1, 10

_SPAN = "array<struct<s:int,k:int,e:int,v:string>>"


def running(x: Column, op, none) -> Column:
    """op (sum, maximum ...) of an array's numbers up to and with each element, none being its neutral number: log2(size) passes, each
    taking in what lies 1, 2, 4 ... before."""
    steps = F.when(F.size(x) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(x).cast("double"))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def join(acc: Column, step: Column) -> Column:
        before = F.slice(F.concat(F.array_repeat(F.lit(none), F.pow(F.lit(2.0), step).cast("int")), acc), F.lit(1), F.size(acc))
        return F.zip_with(acc, before, op)

    return F.aggregate(steps, x, join)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s,e,m>> of the leftmost non-overlapping matches: code points from s to before e, and their text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
    out = F.zip_with(running(pairs, lambda a, b: a + b, 0), found, lambda e, m: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))
    # most texts have no match: for them one test is all
    return F.when(text.rlike(pattern), out).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def _spans(found: Column, kind: str, value) -> Column:
    """Spans s, k (number of the kind), e with their value, which is what ownership is counted of."""
    k = KINDS.index(kind)
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), value(x["m"]).alias("v")))


def written(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def looks_random(m: Column) -> Column:
    """Whether a string has digits, and letters of both cases, or digits amid letters of one case, with many changes between them."""
    changes = F.size(F.split(m, r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])", -1)) - 1
    return m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (5 * changes >= F.length(m))


def candidate_rows(docs: DataFrame) -> DataFrame:
    """The other columns of docs (with a column text) and, of each text, base and free: spans of the base kinds by start and kind, and
    of general candidates that look random and touch none of them."""
    text = F.col("text")
    least = f"(?i)^.*?[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]{{{ASSIGN_LEAST},}})$"
    assign = F.filter(matches(text, ASSIGN), lambda x: x["m"].rlike(least))
    whole = lambda m: m
    base = F.concat(_spans(assign, "assign", lambda m: F.regexp_extract(m, ASSIGN, 2)), _spans(matches(text, ACCESS), "access", whole), _spans(matches(text, HEX), "hex", whole))
    general = F.filter(matches(text, CANDIDATE), lambda x: looks_random(x["m"]))
    # through generators of one row, so that no expression is worked out again where it is used
    out = docs.select("*", F.inline(F.array(F.struct(F.array_sort(base).alias("base"), _spans(general, "live", whole).alias("all")))))
    # both sorted together: a general candidate is free if no base span that begins before it ends within or after it, and the next begins after it
    both = F.array_sort(F.concat(F.transform("base", lambda x: F.struct(x["s"].alias("s"), F.lit(0).alias("k"), x["e"].alias("e"), x["v"].alias("v"))), F.col("all")))
    out = out.withColumn("both", F.when((F.size("base") > 0) & (F.size("all") > 0), both))
    is_base, far = lambda x: x["k"] == 0, 2**31 - 1
    ended = running(F.transform("both", lambda x: F.when(is_base(x), x["e"]).otherwise(0)), lambda a, b: F.greatest(a, b), 0)
    begins = F.reverse(running(F.reverse(F.transform("both", lambda x: F.when(is_base(x), x["s"]).otherwise(far))), lambda a, b: F.least(a, b), far))
    apart = F.zip_with(F.zip_with(ended, begins, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.col("both"), lambda n, x: F.when(~is_base(x) & (n["a"] <= x["s"]) & (n["b"] >= x["e"]), x))
    free = F.when(F.col("both").isNull(), F.col("all")).otherwise(F.filter(apart, lambda x: x.isNotNull()))
    return out.select(*[c for c in docs.columns if c != "text"], "base", free.alias("free"))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, repositories, owners: distinct counts over the whole corpus of rows (hash, owner, repo); a repository is one owner's.

    Rows are first reduced to one for each hash, owner and repository where they lie, so that a string that is everywhere
    reaches its task as few rows; so are the counts by owner before they meet.
    """
    each = candidates.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = each.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("repos").alias("repositories"), F.count("*").alias("owners"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_base_live, n_example, judged of each row of docs.

    Every candidate, the base spans among them, is judged by the distinct owners and repositories that hold its value (assign: what is
    assigned): more than max_owners or max_repositories make it an example, else it is live if it looks random, else plain. spans has all
    base spans and, as kind live, the live ones of the general candidates, which touch no base span. n_live counts all live ones,
    n_base_live those among the base spans, n_example the examples; judged lists (kind, start, end, verdict, repositories, owners)
    of every candidate by start. Documents are read once; what they hold is written without their texts and joined by row.

    Without repo_col each document (by id) is a repository of its own. Null text counts as empty; null owners, ids and repositories
    are a value of their own; repeated rows give a row each, with the same spans, and count once; other columns are left out; an
    empty table gives none.
    """
    rows = keep(docs, doc_id=id_col, text=text_col, owner=owner_col, **({"repo": repo_col} if repo_col else {}))
    repo = F.col("repo").cast("string") if repo_col else F.col("doc_id").cast("string")
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("owner").cast("string").alias("owner"), repo.alias("repo"), F.monotonically_increasing_id().alias("row"))
    found = stored(candidate_rows(rows), "secrets")  # the row numbers are read back, never made again
    cand = found.where("size(base) + size(free) > 0").select("row", "owner", "repo", F.explode(F.concat("base", "free")).alias("x"))
    cand = cand.select("row", "owner", "repo", F.sha2("x.v", 256).alias("hash"), "x.s", "x.k", "x.e", looks_random(F.col("x.v")).alias("random"))
    known = spread_join(cand, stored(ownership(cand), "ownership"), ["hash"], ["row", "s", "k"])
    verdict = F.when((F.col("owners") > max_owners) | (F.col("repositories") > max_repositories), F.lit("example")).when(F.col("random"), F.lit("live")).otherwise(F.lit("plain"))
    one = F.struct("s", "k", "e", verdict.alias("verdict"), "repositories", "owners")
    judged = known.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("j"))  # a row's own candidates
    live = KINDS.index("live")
    has = lambda test: F.size(F.filter("j", test)).cast("long")
    count = lambda kind: F.size(F.filter("base", lambda x: x["k"] == KINDS.index(kind))).cast("long")
    names = F.array(*[F.lit(k) for k in KINDS])
    out = found.join(judged, "row", "left").withColumn("j", F.coalesce("j", F.array().cast("array<struct<s:int,k:int,e:int,verdict:string,repositories:bigint,owners:bigint>>")))
    more = F.transform(F.filter("j", lambda x: (x["k"] == live) & (x["verdict"] == "live")), lambda x: F.struct(x["s"], x["k"], x["e"], F.lit("").alias("v")))
    return out.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.concat(F.col("base").cast(_SPAN), more.cast(_SPAN))).alias("spans"),
        has(lambda x: x["verdict"] == "live").alias("n_live"), has(lambda x: (x["verdict"] == "live") & (x["k"] != live)).alias("n_base_live"),
        has(lambda x: x["verdict"] == "example").alias("n_example"),
        F.transform("j", lambda x: F.struct(F.element_at(names, x["k"] + 1).alias("kind"), x["s"].alias("start"), x["e"].alias("end"), x["verdict"].alias("verdict"), x["repositories"].alias("repositories"), x["owners"].alias("owners"))).alias("judged"),
    )
