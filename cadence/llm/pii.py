"""Personal data: base patterns, and bootstrapped contextual extraction on top.

Base entities (email, ip, card, phone) are found by regular expressions and checks. They are
the seeds. Every identifier-shaped token (with a digit or an at sign) together with the words
on its left is an edge of a pattern-instance graph: the pattern is the last word, or the last
two; the instance is the token. Spark scores the graph round by round: a pattern's confidence
is the mean score of its distinct instances, an instance's score is 1 for a seed, else the
noisy-or of the confident patterns it stands in. Patterns with enough support and confidence
are accepted; what they extract counts as support in the next round; rounds end when no
pattern is added. Tokens in an accepted pattern that are not base entities are discovered
identifiers (kind `context`).

DataFrame expressions only. A regular expression marks its matches with \\x01 and the marked
text is split there, which gives the places of all matches in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import cut, query, read

# The base patterns. Possessive forms match the same strings as the greedy ones
# (nothing after them could make use of backtracking). A match can start in the middle of a run
# of its characters only where the last match ended (\G), so long runs cost no quadratic time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "context"]
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_OK = rf"^{_PART}(?:\.{_PART}){{3}}$"
CANDIDATE = r"(?<![^\s:=])[^\s:=0-9@]*+[0-9@][^\s:=]*+"
OPENING, CLOSING = r"^[(\"'\[{<]+", r"[)\"'\]}>.,;:!?]+$"
WINDOW = 80            # characters on the left that are looked at first for a pattern's two words
MIN_SUPPORT = 5.0      # summed score of a pattern's distinct instances
MIN_CONFIDENCE = 0.9   # score of a pattern's known instances: seeds and reached ones against other things
MIN_SHARE = 0.4        # summed score by all of a pattern's distinct instances, unknown ones included

MARK = "\x01"


def _pieces(text: Column, pattern: str, needs: Column) -> Column:
    """[before, match, between, match, ..., after]; the whole text alone where ``needs`` fails."""
    clean = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, "\x02")).otherwise(text)
    marked = F.regexp_replace(clean, f"({pattern})", f"{MARK}$1{MARK}")
    return F.when(needs, F.split(marked, MARK, -1)).otherwise(F.array(F.lit("")))


def _matches(pieces: Column) -> Column:
    """array of struct(start, end, value, left) from `_pieces`; left: the end of the text between the last
    match and this one, its last `WINDOW` characters if they hold two whole words, else all of it."""
    none = F.array().cast("array<struct<start:long,end:long,value:string,left:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(False).alias("match"), F.lit("").alias("left"), none.alias("out"))

    def step(s, piece):
        end, near = s["at"] + F.length(piece), F.substring(piece, -WINDOW, WINDOW)
        left = F.when(near.rlike(r"\s\S+\s+\S+\s*$"), near).otherwise(piece)
        found = F.struct(s["at"].alias("start"), end.alias("end"), piece.alias("value"), s["left"].alias("left"))
        return F.struct(end.alias("at"), (~s["match"]).alias("match"),
                        F.when(s["match"], F.lit("")).otherwise(left).alias("left"),
                        F.when(s["match"], F.array_append(s["out"], found)).otherwise(s["out"]).alias("out"))
    return F.aggregate(pieces, start, step, lambda s: s["out"])


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(IP_OK)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array of struct(start, rank, end): the base entities of a text, sorted by start, then kind.
    Offsets count code points, ends are exclusive; rank is the kind's place in `KINDS`."""
    digit = text.rlike("[0-9]")
    needs = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+"))}

    def of(kind: str) -> Column:
        good = F.filter(_matches(_pieces(text, PATTERNS[kind], needs[kind])), lambda m: _valid(kind, m["value"]))
        return F.transform(good, lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end")))
    return F.array_sort(F.concat(*map(of, PATTERNS)))


def candidates(text: Column, spans: Column) -> Column:
    """array of struct(start, end, instance, one, two, seed): identifier-shaped tokens, the last
    word and last two words on their left (null where there are none), and whether a base
    entity starts there. Tokens inside a base entity are left out."""
    found = _matches(_pieces(text, CANDIDATE, text.rlike("[0-9@]")))

    def shaped(m):
        start = m["start"] + F.length(F.regexp_extract(m["value"], OPENING, 0))
        core = F.regexp_replace(F.regexp_replace(m["value"], OPENING, ""), CLOSING, "")
        words = F.filter(F.split(F.lower(m["left"]), r"\s+"), lambda w: w != "")
        return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), F.lower(core).alias("instance"),
                        F.when(F.size(words) > 0, F.element_at(words, -1)).alias("one"),
                        F.when(F.size(words) > 1, F.concat_ws(" ", F.slice(words, -2, 2))).alias("two"),
                        F.exists(spans, lambda s: (s["start"] >= m["start"]) & (s["start"] < m["end"])).alias("seed"))
    outside = F.filter(found, lambda m: ~F.exists(spans, lambda s: (s["start"] < m["start"]) & (m["start"] < s["end"])))
    return F.filter(F.transform(outside, shaped), lambda c: c["instance"].rlike("[0-9@]"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, same, spans, found): one row per document; ``same`` is a hash of its text.
    Written to the shared folder, without the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    d = d.withColumn("spans", base_spans(F.col("text")))
    return cut(d.select("doc_id", F.xxhash64("text").alias("same"), "spans",
                        candidates(F.col("text"), F.col("spans")).alias("found")))


def accepted_patterns(occurrences: DataFrame, min_support: float = MIN_SUPPORT,
                      min_confidence: float = MIN_CONFIDENCE, min_share: float = MIN_SHARE) -> DataFrame:
    """(pattern, confidence) after the last round. ``occurrences``: (pattern, instance, seed).

    An instance that is no seed speaks against a pattern if it is known to be something else: if it
    also stands in a pattern that has instances enough and not one seed among them. An instance that is seen nowhere
    else is unknown and speaks neither for nor against, as long as ``min_share`` of the instances are known to be
    identifiers."""
    edges = cut(occurrences.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    plain = (edges.groupBy("pattern").agg(F.max("seed").alias("any"), F.count(F.lit(1)).alias("n"))
             .filter(~F.col("any") & (F.col("n") >= min_support)).select("pattern"))
    other = edges.join(plain, "pattern").groupBy("instance").agg(F.lit(1).alias("other"))
    edges = cut(edges.join(other, "instance", "left").select(
        "pattern", "instance", "seed", F.when(~F.col("seed"), F.col("other")).alias("other")))
    seeds = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("fixed"))
    scores, before = seeds.withColumnRenamed("fixed", "score"), -1
    while True:
        confident = cut(edges.join(scores, "instance").groupBy("pattern")
                        .agg(F.sum("score").alias("support"), F.avg("score").alias("share"),
                             F.sum(F.when(F.col("other") == 1, 1 - F.col("score")).otherwise(0.0)).alias("against"))
                        .withColumn("confidence", F.col("support") / F.greatest(F.col("support") + F.col("against"), F.lit(1e-9)))
                        .filter((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)
                                & (F.col("share") >= min_share))
                        .select("pattern", "confidence"))
        now = confident.count()
        if now <= before or not now:
            return confident
        before = now
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        reached = edges.join(confident, "pattern").groupBy("instance").agg((1 - doubt).alias("reached"))
        scores = (seeds.join(reached, "instance", "left")
                  .select("instance", F.greatest("fixed", F.coalesce("reached", F.lit(0.0))).alias("score")))


def discovered(scanned: DataFrame, **limits) -> DataFrame:
    """(doc_id, same, more): spans that accepted patterns extract and no base entity starts in."""
    one = scanned.select("doc_id", "same", F.explode("found").alias("c"))
    pairs = one.select("doc_id", "same", "c.*").select(
        "doc_id", "same", "start", "end", "instance", "seed", F.explode(F.array("one", "two")).alias("pattern")
    ).filter(F.col("pattern").rlike(r"\p{L}"))
    confident = accepted_patterns(pairs.select("pattern", "instance", "seed"), **limits)
    return (pairs.filter("not seed").join(confident, "pattern")
            .groupBy("doc_id", "same", "start", "end").agg(F.count(F.lit(1)))
            .groupBy("doc_id", "same").agg(F.collect_list(F.struct(
                "start", F.lit(KINDS.index("context")).alias("rank"), "end")).alias("more")))


def find_personal_data(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, base, all): arrays of struct(start, rank, end), one row per document.

    Null text counts as empty and has no spans. Rows with equal id and text, also with a null
    id, get equal spans. An empty table gives no rows.
    """
    scanned = scan(docs)
    more = discovered(scanned, **limits).withColumnsRenamed({"doc_id": "__d", "same": "__s"})
    return (scanned.join(more, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("same") == F.col("__s")), "left")
            .select("doc_id", F.col("spans").alias("base"),
                    F.when(F.col("more").isNull(), F.col("spans"))
                    .otherwise(F.array_sort(F.concat("spans", "more"))).alias("all")))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets, and n_chars (if
    there) following. Overlapping spans become one, named after the first. Null texts stay null."""
    more = discovered(scan(docs), **limits).withColumnsRenamed({"doc_id": "__d", "same": "__s", "more": "__more"})
    columns = docs.columns
    d = docs.withColumn("__text", F.coalesce("text", F.lit(""))).withColumn("__same", F.xxhash64("__text"))
    d = d.join(more, F.col("doc_id").cast("long").eqNullSafe(F.col("__d")) & (F.col("__same") == F.col("__s")), "left")
    d = d.withColumn("__spans", F.array_sort(F.concat(base_spans(F.col("__text")), F.coalesce(
        "__more", F.array().cast("array<struct<start:long,rank:int,end:long>>")))))
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("__text")

    def step(s, x):
        cutting = x["start"] >= s["at"]
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(cutting, F.concat(
            s["out"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")),
            F.element_at(kinds, x["rank"] + 1))).otherwise(s["out"]).alias("out"))
    clean = F.aggregate("__spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step,
                        lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    d = d.withColumn("__clean", F.when(F.size("__spans") > 0, clean).otherwise(F.col("text")))
    new = {"text": F.col("__clean")} | ({"n_chars": F.when(F.size("__spans") > 0, F.length("__clean").cast("long"))
                                         .otherwise(F.col("n_chars"))} if "n_chars" in columns else {})
    return d.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns])


@query("op6_pii")
def op6_pii(spark, sf_dir):
    out = find_personal_data(read(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, PATTERNS), F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                      written(F.col("all")).alias("spans"))
