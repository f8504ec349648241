"""Personal data: base patterns and bootstrapped contextual extraction (op 1).

Only DataFrame functions: no Python runs on the executors.

Base spans are four patterns (email, ip, card, phone), leftmost and
non-overlapping per kind, with checks (ip parts at most 255, Luhn, digit
counts).  Positions are code points: a text is split at the matches, and the
lengths of pieces and matches add up.

Bootstrapping starts from the base spans as seeds:

* candidates are identifier-shaped: tokens with a digit or an @, and groups of digits
  parted by single spaces; a seed is one that shares a digit or @ with a base span;
* a candidate's patterns are the word to its left, the two words there, the word to
  its right, the words on both sides, the word to its left with the candidate's shape
  (letters and digits folded), and its own ``name=`` / ``name:`` prefix;
* candidates and patterns form a graph.  In each round a pattern's confidence is
  the weight of its instances over all its occurrences in the corpus (any word
  may stand there, so common words score near zero; a shape counts among the
  candidates after its word), and an instance's weight is the noisy-or of its
  confident patterns;
* instances found by confident patterns that are no base span are added as spans
  of kind ``id``, wherever they occur.

A pattern needs ``MIN_SUPPORT`` different good instances, so those with fewer
instances in all never count and are left out before anything is joined.  Hot
patterns and words are counted by partial aggregates; joins are on unique
aggregated keys.

Positions come from running sums in blocks, seeds from comparing the tokens of the
text with those of a copy whose base matches are marked: both are linear in the
number of matches.

Defined cases: null text is empty and has no spans; repeated rows get a row
each; an empty table gives no rows; a text of any length, with any number of matches,
is read whole; equal confidences need no order; other input columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.staging import Staging, documents, keys_and_text
from shoplens.plans.joins import broadcast_rows

KINDS = ("email", "ip", "card", "phone", "id")

# The contract's patterns.  A match may begin after the previous one or where the
# run of its first characters begins, and runs don't give back: same matches, in
# linear time on long runs.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Marks of a base match's digits and @, for finding seeds.
_DIGIT, _AT = "\ue000", "\ue001"


def _token(digit: str, at: str) -> str:
    return (rf"(?<!\S)(?:[+(]?{digit}(?:{digit}|[().+-])*+(?:\x20(?:{digit}|\()(?:{digit}|[().-])*+)++[.,;:!?]*+(?!\S)"
            rf"|(?:(?!{digit}|{at})\S)*+(?:{digit}|{at})\S*+)")


TOKEN = _token("[0-9]", "@")
_MARKED_TOKEN = _token(f"[0-9{_DIGIT}]", f"[@{_AT}]")
_BLOCK = 128             # matches whose positions are summed together

ROUNDS = 3
MIN_CONFIDENCE = 0.6     # weight of the instances over all occurrences of a pattern
MIN_SUPPORT = 3          # different positive instances of a pattern
MIN_WEIGHT = 0.6         # from which an instance is taken for an identifier


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as the element of a one-element array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text: Column, pattern: str) -> Column:
    """struct(pairs, tail): for each match the piece before it and the match; what follows the last."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))
    return _bound(found, lambda x: F.struct(
        F.arrays_zip(F.slice(x["p"], F.lit(1), F.size(x["m"])).alias("p"), x["m"].alias("m")).alias("pairs"),
        F.element_at(x["p"], -1).alias("tail")))


def starts(pairs: Column) -> Column:
    """The start of each match in code points: running sums inside blocks, and over the blocks' totals."""
    add = lambda acc, x: acc + x
    total = lambda xs: F.aggregate(xs, F.lit(0), add)

    def over(lengths):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / F.lit(_BLOCK)).cast("int")),
                             lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))
        ends = _bound(blocks, lambda bs: _bound(F.transform(bs, total), lambda sums: F.flatten(F.transform(
            bs, lambda block, b: _bound(total(F.slice(sums, F.lit(1), b)), lambda base: F.transform(
                block, lambda x, i: base + total(F.slice(block, F.lit(1), i))))))))
        return F.when(F.size(lengths) > 0, ends).otherwise(F.array().cast("array<int>"))

    before = _bound(F.transform(pairs, lambda x: F.char_length(x["p"]) + F.char_length(x["m"])), over)
    return F.zip_with(before, pairs, lambda s, x: s + F.char_length(x["p"]))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True when the digits pass the Luhn check."""
    back = F.reverse(number)

    def step(total, i):
        d = F.substr(back, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, F.lit(9)).otherwise(F.lit(0)))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(number)), F.lit(0), step) % 10 == 0


def _number_of_digits(m: Column) -> Column:
    return F.char_length(digits(m))


def _kinds(text: Column):
    """Per base kind: whether the text may hold one, its pattern, and the check of a match."""
    ip = "^" + r"\.".join([r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?|(?<=0))"] * 4) + "$"
    return [
        (F.contains(text, F.lit("@")), EMAIL, lambda m: F.lit(True)),
        (text.rlike(r"[0-9]\.[0-9]"), IP, lambda m: m.rlike(ip)),
        (text.rlike("[0-9][ -]?[0-9]"), CARD, lambda m: F.when(_number_of_digits(m).between(13, 19), luhn(digits(m))).otherwise(F.lit(False))),
        (text.rlike(r"\+[0-9]"), PHONE, lambda m: _number_of_digits(m).between(9, 15)),
    ]


def _checked(kind: int, ok):
    """Of the matches of a kind: its spans, and the text with the good matches' digits and @ marked."""
    def spans(pairs):
        placed = F.zip_with(starts(pairs), pairs, lambda s, x: F.struct(
            F.lit(kind).alias("kind"), s.alias("s"), (s + F.char_length(x["m"])).alias("e"), x["ok"].alias("ok")))
        return F.transform(F.filter(placed, lambda x: x["ok"]), lambda x: F.struct(x["kind"], x["s"], x["e"]))

    def marked(pairs, tail):
        pieces = F.transform(pairs, lambda x: F.concat(_plain(x["p"]), F.when(x["ok"], F.translate(
            x["m"], "0123456789@", _DIGIT * 10 + _AT)).otherwise(x["m"])))
        return F.when(F.exists(pairs, lambda x: x["ok"]), F.concat(F.array_join(pieces, ""), _plain(tail)))

    def of_kind(found):
        pairs = F.transform(found["pairs"], lambda x: F.struct(x["p"].alias("p"), x["m"].alias("m"), ok(x["m"]).alias("ok")))
        return _bound(pairs, lambda xs: F.struct(spans(xs).alias("spans"), marked(xs, found["tail"]).alias("marked")))

    return of_kind


def base_spans(text: Column) -> Column:
    """struct(spans, marked): array of (kind, s, e) in the order of kinds, then starts; and the texts with marked matches."""
    nothing = F.struct(F.from_json(F.lit("[]"), "array<struct<kind: int, s: int, e: int>>").alias("spans"), F.lit(None).cast("string").alias("marked"))
    kinds = [F.when(maybe, _bound(matches(text, pattern), _checked(kind, ok))).otherwise(nothing)
             for kind, (maybe, pattern, ok) in enumerate(_kinds(text))]
    return _bound(F.array(*kinds), lambda ks: F.struct(
        F.flatten(F.transform(ks, lambda k: k["spans"])).alias("spans"),
        F.filter(F.transform(ks, lambda k: k["marked"]), lambda m: m.isNotNull()).alias("marked")))


def _plain(piece: Column) -> Column:
    return F.translate(piece, _DIGIT + _AT, "??")


def _patterns(name: Column, inst: Column, left2: Column, left1: Column, right: Column) -> Column:
    """The patterns of a candidate; empty words are no context."""
    shape = F.regexp_replace(F.regexp_replace(inst, "[0-9]++", "9"), "[A-Za-z]++", "a")
    has = lambda *words: reduce(lambda x, y: x & y, [w != "" for w in words])
    return F.filter(F.array(
        F.when(has(name), F.concat(F.lit("n "), name)),
        F.when(has(left1), F.concat(F.lit("l "), left1)),
        F.when(has(left2, left1), F.concat_ws(" ", F.lit("ll"), left2, left1)),
        F.when(has(right), F.concat(F.lit("r "), right)),
        F.when(has(left1, right), F.concat_ws(" ", F.lit("lr"), left1, right)),
        F.when(has(left1), F.concat_ws(" ", F.lit("ls"), left1, shape))), lambda x: x.isNotNull())


def context_counts(text: Column) -> Column:
    """The contexts at every word of a text, as ``_patterns`` names those at candidates (but for names and shapes)."""
    def at(words):
        return F.flatten(F.transform(words, lambda w, i: F.filter(F.array(
            F.concat(F.lit("l "), w), F.when(i > 0, F.concat_ws(" ", F.lit("ll"), F.get(words, i - 1), w)), F.concat(F.lit("r "), w),
            F.when(F.get(words, i + 2).isNotNull(), F.concat_ws(" ", F.lit("lr"), w, F.get(words, i + 2)))), lambda x: x.isNotNull())))

    return _bound(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), at)


def candidates(text: Column, marked: Column) -> Column:
    """Array of (s, e, inst, seed, patterns): identifier-shaped tokens without outer punctuation."""
    none = F.from_json(F.lit("[]"), "array<struct<s: int, e: int, inst: string, seed: int, patterns: array<string>>>")
    punctuation = r"""["')>\],.;:!?]"""

    def of(found):
        tokens = F.transform(marked, lambda m: F.regexp_extract_all(m, F.lit(_MARKED_TOKEN), F.lit(0)))
        return _bound(F.struct(found["pairs"].alias("pairs"), starts(found["pairs"]).alias("at"), found["tail"].alias("tail"), tokens.alias("tokens")),
                      lambda x: F.transform(x["pairs"], lambda pair, i: one(x, pair, i)))

    def one(x, pair, i):
        m, before = pair["m"], F.lower(pair["p"])
        after = F.lower(F.when(i + 1 < F.size(x["pairs"]), F.get(x["pairs"], i + 1)["p"]).otherwise(x["tail"]))
        words = r"(?<!\S)(?:(\S++)\s++)?(\S++)\s++$"
        head = F.regexp_extract(m, r"""^(?:[A-Za-z_][A-Za-z_-]*+[:=])?["'(<\[]*+""", 0)
        name = F.lower(F.regexp_extract(head, r"^([A-Za-z_][A-Za-z_-]*+[:=])", 1))
        core = F.regexp_replace(F.substr(m, F.char_length(head) + 1), rf"(?<!{punctuation}){punctuation}++$", "")
        s = F.get(x["at"], i) + F.char_length(head)
        seed = F.exists(x["tokens"], lambda t: F.coalesce(F.get(t, i).rlike(f"[{_DIGIT}{_AT}]"), F.lit(False)))
        right = F.when(m.rlike(punctuation + "$"), "").otherwise(F.regexp_extract(after, r"^\s++(\S++)", 1))
        return F.struct(s.alias("s"), (s + F.char_length(core)).alias("e"), core.alias("inst"), seed.cast("int").alias("seed"),
                        _patterns(name, core, F.regexp_extract(before, words, 1), F.regexp_extract(before, words, 2), right).alias("patterns"))

    found = F.when(text.rlike("[0-9@]"), _bound(matches(text, TOKEN), of)).otherwise(none)
    return F.filter(found, lambda x: (F.char_length(x["inst"]) >= 4) & x["inst"].rlike("[0-9][^0-9]*+[0-9]|@"))


def spell(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def bootstrap(edges: DataFrame, occurrences: DataFrame, staging: Staging, rounds: int = ROUNDS) -> DataFrame:
    """Instances (inst, weight) that confident patterns point to and that are no seeds.

    ``edges``: pattern, inst, n, seed (0/1), one row a pair; ``occurrences``:
    pattern, total.
    """
    graph = staging.save(edges.join(occurrences, "pattern"), "graph")
    weights = graph.groupBy("inst").agg(F.max("seed").cast("double").alias("w"), F.max("seed").alias("is_seed"))
    for r in range(rounds):
        seen = graph.join(weights.select("inst", "w"), "inst")
        patterns = seen.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("w")) / F.greatest(F.max("total"), F.sum("n"))).alias("confidence"),
            F.count_if(F.col("w") >= MIN_WEIGHT).alias("support")).where(
            (F.col("confidence") >= MIN_CONFIDENCE) & (F.col("support") >= MIN_SUPPORT))
        patterns = staging.save(patterns, f"patterns{r}")
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1.0 - F.coalesce("confidence", F.lit(0.0)))))
        weights = graph.join(patterns.select("pattern", "confidence"), "pattern", "left").groupBy("inst").agg(
            F.max("seed").alias("is_seed"), F.greatest(F.max("seed").cast("double"), 1.0 - F.exp(doubt)).alias("w"))
        weights = staging.save(weights, f"weights{r}")
    return weights.where((F.col("is_seed") == 0) & (F.col("w") >= MIN_WEIGHT)).select("inst", F.col("w").alias("weight"))


def pattern_totals(docs: DataFrame, edges: DataFrame, live: DataFrame, staging: Staging) -> DataFrame:
    """pattern, total: occurrences in the corpus of the patterns of ``live``.

    Contexts are counted over all words of all documents; those of no live pattern
    are dropped where they are read if the list passes the size check.
    """
    contexts = keys_and_text(docs).select(F.explode(context_counts(F.coalesce("text", F.lit("")))).alias("pattern"))
    known = broadcast_rows(live, live.count())
    words = contexts.join(known, "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    # A shape counts among the candidates after its word, whatever their shape.
    word = F.element_at(F.split("pattern", " "), 2)
    after = edges.where(F.col("pattern").startswith("l ")).groupBy(word.alias("word")).agg(F.sum("n").alias("total"))
    shapes = live.where(F.col("pattern").startswith("ls ")).withColumn("word", word).join(after, "word").select("pattern", "total")
    counted = words.unionByName(shapes)
    return staging.save(live.join(counted, "pattern", "left").select("pattern", F.coalesce("total", F.lit(0)).alias("total")), "totals")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row: counts of the base kinds, digest of the base spans, all spans, number of added ones."""
    st = Staging(docs.sparkSession, "pii")
    text = F.coalesce(F.col("text"), F.lit(""))
    based = keys_and_text(docs).select("doc_id", text.alias("text"), base_spans(text).alias("b"))
    rows = based.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("b.spans").alias("base"),
                        candidates(F.col("text"), F.col("b.marked")).alias("cands"))
    rows = st.save(rows, "spans")                 # row numbers are fixed from here on
    found = rows.select("rid", F.explode("cands").alias("c")).select("rid", "c.*")
    edges = found.select("inst", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "inst").agg(
        F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    edges = st.save(edges, "edges")               # one row a pair of pattern and instance
    live = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= MIN_SUPPORT).select("pattern")
    live = st.save(live, "live")
    new = bootstrap(edges, pattern_totals(docs, edges, live, st), st)
    added = found.where("seed = 0").join(new, "inst").groupBy("rid").agg(
        F.sort_array(F.collect_set(F.struct(F.lit(4).alias("kind"), "s", "e"))).alias("more"))
    out = rows.select("rid", "doc_id", "base").join(added, "rid", "left")
    more = F.coalesce("more", F.from_json(F.lit("[]"), "array<struct<kind: int, s: int, e: int>>"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint")
    return out.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
                      F.sha2(spell(F.col("base")), 256).alias("base_sha256"), spell(F.concat("base", more)).alias("spans"),
                      F.size(more).cast("bigint").alias("n_found"))


def personal_data_query(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))
