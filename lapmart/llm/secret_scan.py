"""Secret scan: patterns of known kinds, and a randomness test battery for other tokens.

Everything here is DataFrame and SQL functions.  Texts without any cue are
passed over by plain substring searches and one pattern; in the others
``split`` gives the gaps between matches and ``regexp_extract_all`` the
matches, so positions are running sums of lengths.

Other tokens are runs of at least ``MIN_TOKEN`` characters of encoded data.
Spans of known kinds are left out of a run; of the rest, the longest stretches
of base64 characters, of base64url characters, and of letters and digits are
tokens, so the parts of a path, a URL or ``name=value`` are tested as well as
the whole.  Reported tokens that overlap become one span.
By its characters a token is taken for hexadecimal, base32, base36 or base64;
words without digits are taken for none.  Under the hypothesis that it is
uniformly random in that alphabet, three tests give p-values: chi-squared on
symbol counts, Wald-Wolfowitz runs of the alphabet's halves, and lag-1 serial
correlation of symbol values.  Bonferroni combines them.  Benjamini-Hochberg,
within each encoding and length class since a test's power grows with
length, then decides which tokens are not random; of those at most ``FDR``
are expected to be random ones.  The others are reported.  P-values are
counted in logarithmic bins, so the decision never sorts all tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapmart.llm.common import free_name, reads, written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Runs shorter than wanted would be dropped, and no run starts inside another: the least length can stand in
# the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIN_VALUE = 6
MIN_TOKEN = 20
TOKEN = "[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN
PARTS = tuple("[A-Za-z0-9%s]{%d,}(?:=+(?![A-Za-z0-9+/_=-]))?" % (more, MIN_TOKEN) for more in ("+/", "_-", ""))
BUCKET = 4096  # characters; spans are matched within buckets of a text
FDR = 0.01
BINS = 200  # tenths of -log10 p
REDACTED = "[REDACTED]"

_ENCODINGS = (  # name, pattern, alphabet
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("hexupper", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36upper", "^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (gap: characters before the match, match, value: the group)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    return F.transform(F.arrays_zip(found.alias("m"), value.alias("v")),
                       lambda x, i: F.struct(F.get(gaps, i).alias("gap"), x["m"].alias("m"), x["v"].alias("v")))


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """Each row's matches by kind (written): rid, the columns ``keep``, and found (kind, gap, match, value)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    cue = F.lit(False)
    for word in ASSIGN_CUES:
        cue = cue | F.contains(low, F.lit(word))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), *keep, text.alias("text"), cue.alias("cue"),
                       F.rlike(text, F.lit(TOKEN.replace(",", ""))).alias("run"))
    text, run = F.col("text"), F.col("run")
    kinds = ((F.col("cue"), ASSIGN, 2), (run & F.contains(text, F.lit("AKIA")), ACCESS, 0), (run, HEX, 0),
             (run, TOKEN, 0))
    arrays = [F.when(gate, _matches(text, pattern, group)).alias(kind)
              for kind, (gate, pattern, group) in zip(KINDS, kinds)]
    return written(rows.select("rid", *keep, *arrays), "secrets-found")


def positions(found: DataFrame) -> DataFrame:
    """One row per match: rid, kind (its place in ``KINDS``), start, end, value."""
    each = None
    for number, kind in enumerate(KINDS):
        part = (found.where(F.size(kind) > 0)
                .select("rid", F.lit(number).alias("kind"), F.posexplode(kind).alias("i", "x")))
        each = part if each is None else each.union(part)
    w = W.partitionBy("rid", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("x.gap") + F.length("x.m")).over(w)
    return each.select("rid", "kind", (end - F.length("x.m")).alias("start"), end.alias("end"), F.col("x.v").alias("value"))


def _bucketed(at: DataFrame) -> DataFrame:
    return at.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / BUCKET), F.floor((F.col("end") - 1) / BUCKET))))


def tokens(runs: DataFrame, base: DataFrame) -> DataFrame:
    """Stretches to test of runs(rid, start, end, value) outside the spans of base(rid, start, end), each once."""
    known = _bucketed(base.select("rid", "start", "end")).select("rid", "bucket", F.struct("start", "end").alias("b"))
    near = _bucketed(runs.select("rid", "start", "end")).join(known, ["rid", "bucket"]).where(
        (F.col("b.start") < F.col("end")) & (F.col("start") < F.col("b.end")))
    cuts = near.groupBy("rid", "start").agg(F.collect_set("b").alias("cuts"))
    rest = F.expr("""aggregate(coalesce(cuts, array()), value, (v, b) -> concat(
        substring(v, 1, cast(greatest(b.start - start, 0) as int)),
        repeat(' ', cast(least(b.end, end) - greatest(b.start, start) as int)),
        substring(v, cast(least(b.end, end) - start + 1 as int))))""")
    rows = runs.select("rid", "start", "end", "value").join(cuts, ["rid", "start"], "left")
    rows = rows.select("rid", F.col("start").alias("run"), rest.alias("rest"))
    each = None
    for number, pattern in enumerate(PARTS):
        part = rows.select("rid", "run", F.lit(number).alias("part"),
                           F.posexplode(_matches(F.col("rest"), pattern)).alias("i", "x"))
        each = part if each is None else each.union(part)
    w = W.partitionBy("rid", "run", "part").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.col("run") + F.sum(F.col("x.gap") + F.length("x.m")).over(w)
    return (each.select("rid", (end - F.length("x.m")).alias("start"), end.alias("end"), F.col("x.m").alias("value"))
            .groupBy("rid", "start", "end").agg(F.first("value").alias("value")))


def merged(at: DataFrame) -> DataFrame:
    """(rid, start, end) with overlapping spans as one."""
    w = W.partitionBy("rid").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    first = (before.isNull() | (F.col("start") >= before)).cast("int")
    number = F.sum("first").over(w.rowsBetween(W.unboundedPreceding, 0))
    return (at.select("rid", "start", "end", first.alias("first")).withColumn("number", number)
            .groupBy("rid", "number").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("number"))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0 (Abramowitz and Stegun 26.2.17, to 1e-7)."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) * 0.3989422804014327 * poly


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds encoding, size (symbols) and p to tokens(value); rows of no encoding are left out."""
    body = F.regexp_replace("value", "=+$", "")
    name, alphabet = F.lit(None), F.lit(None)
    for encoding, pattern, letters in reversed(_ENCODINGS):
        fits = F.rlike(body, F.lit(pattern))
        name = F.when(fits, encoding).otherwise(name)
        alphabet = F.when(fits, letters).otherwise(alphabet)
    mixed = F.rlike(body, F.lit("[0-9]")) & F.rlike(body, F.lit("[A-Za-z]"))
    rows = (tokens.withColumns({"encoding": name, "alphabet": alphabet, "mixed": mixed, "body": body})
            .where(F.col("encoding").isNotNull() & F.col("mixed") & (F.length("body") >= MIN_TOKEN)))
    rows = rows.withColumn("x", F.expr("transform(split(body, ''), c -> instr(alphabet, c) - 1)"))
    rows = rows.withColumns({
        "size": F.size("x").cast("double"), "a": F.length("alphabet").cast("double"),
        "squares": F.expr("aggregate(array_distinct(x), 0D, (s, v) -> s + pow(size(filter(x, u -> u = v)), 2))"),
        "high": F.expr("transform(x, v -> if(v >= length(alphabet) / 2, 1, 0))"),
        "mean": F.expr("aggregate(x, 0D, (s, v) -> s + v) / size(x)")})
    rows = rows.withColumns({
        "ones": F.expr("cast(aggregate(high, 0, (s, v) -> s + v) as double)"),
        "runs": F.expr("1 + size(filter(sequence(1, size(high) - 1), i -> high[i] <> high[i - 1]))"),
        "power": F.expr("aggregate(x, 0D, (s, v) -> s + pow(v - mean, 2))"),
        "lagged": F.expr("aggregate(sequence(1, size(x) - 1), 0D, (s, i) -> s + (x[i] - mean) * (x[i - 1] - mean))")})
    n, a, ones = F.col("size"), F.col("a"), F.col("ones")
    zeros = n - ones
    # Wilson-Hilferty
    df = a - 1
    chi = F.col("squares") * a / n - n
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    p_chi = F.when(z_chi > 0, _tail(z_chi)).otherwise(F.lit(1.0))
    mean_runs = 2 * ones * zeros / n + 1
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    p_runs = F.when(var_runs > 0, 2 * _tail(F.abs(F.col("runs") - mean_runs) / F.sqrt(var_runs))).otherwise(F.lit(0.0))
    z_lag = (F.col("lagged") / F.col("power") + 1 / n) * F.sqrt(n)
    p_lag = F.when(F.col("power") > 0, 2 * _tail(F.abs(z_lag))).otherwise(F.lit(0.0))
    p = F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_lag))
    return rows.select(*tokens.columns, "encoding", F.floor(F.log2(n)).alias("length_class"), p.alias("p"))


def random_tokens(tested: DataFrame) -> DataFrame:
    """Tokens that the test battery, under false-discovery control, does not find to be other than random."""
    klass = ["encoding", "length_class"]
    step = F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest("p", F.lit(1e-30))))).cast("int")
    counts = tested.groupBy(*klass, step.alias("step")).agg(F.count("*").alias("n"))
    w = W.partitionBy(*klass)  # at most BINS + 1 rows each
    below = F.sum("n").over(w.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0))
    bound = F.sum("n").over(w) * F.pow(F.lit(10.0), -F.col("step") / 10) / below
    cut = (counts.withColumn("bound", bound).where(F.col("bound") <= FDR)
           .groupBy(*klass).agg(F.min("step").alias("cut")))
    return (tested.withColumn("step", step).join(cut, klass, "left")
            .where(F.col("cut").isNull() | (F.col("step") < F.col("cut"))).drop("step", "cut"))


def spans(found: DataFrame) -> DataFrame:
    """rid, base and all: arrays of (start, kind, end) by start, then kind; rows without spans are left out."""
    at = positions(found)
    base = at.where(((F.col("kind") == 0) & (F.length("value") >= MIN_VALUE)) | F.col("kind").isin(1, 2))
    runs = at.where(F.col("kind") == 3).select("rid", "start", "end", "value")
    tested = written(randomness(tokens(runs, base)), "secrets-tested")
    random = merged(random_tokens(tested)).withColumn("kind", F.lit(3))
    both = base.drop("value").unionByName(random)
    rows = both.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    return reads(rows.select("rid", F.filter("s", lambda x: x["kind"] < 3).alias("base"), F.col("s").alias("all")),
                 found, tested)


def _joined(array: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(array, lambda x: F.concat(
        F.get(names, x["kind"]), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of ``docs(doc_id, text)``, one row per row.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans, and
    n_random.  Spans are kind:start:end in code points, end exclusive; random
    tokens are looked for outside the spans of other kinds.  A null
    or empty text has no spans; null doc_ids and repeated rows are scanned
    like any other; other columns are ignored; an empty table gives no rows.
    """
    found = candidates(docs, "doc_id")
    each = spans(found)
    rows = found.select("rid", "doc_id").join(each, "rid", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    rows = rows.withColumns({"base": F.coalesce("base", none), "all": F.coalesce("all", none)})
    count = lambda k: F.size(F.filter("all", lambda x: x["kind"] == k)).cast("long")
    return reads(rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("all").alias("spans"),
        count(3).alias("n_random")), each)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by ``REDACTED``; n_chars, if there, follows.

    Overlapping spans are replaced as one.  Rows without spans stay as they are.
    """
    all_, to = (free_name(docs, x) for x in ("_all", "_to"))
    found = candidates(docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")), "row")
    each = spans(found)
    some = F.coalesce(F.greatest(*(F.size(k) for k in KINDS)) > 0, F.lit(False))
    # texts without a match have no spans: they are not shuffled
    rest = found.where(~some).select("row.*")
    cut = each.select("rid", F.col("all").alias(all_))
    # where the spans before each one end
    joined = found.where(some).select("rid", "row").join(cut, "rid", "left").select("row.*", all_).withColumn(to, F.expr(
        f"transform({all_}, (x, i) -> array_max(transform(slice({all_}, 1, i + 1), y -> y.end)))"))
    pieces = F.expr(f"""array_join(concat(
        transform({all_}, (x, i) -> if(i = 0 or x.start >= {to}[i - 1],
          concat(substring(text, if(i = 0, 1, cast({to}[i - 1] + 1 as int)),
                           cast(x.start - if(i = 0, 0, {to}[i - 1]) as int)), '{REDACTED}'), '')),
        array(substring(text, cast({to}[size({to}) - 1] + 1 as int)))), '')""")
    hit = F.size(all_) > 0
    out = joined.withColumn("text", F.when(hit, pieces).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return reads(rest.unionByName(out.select(*docs.columns)), each)
