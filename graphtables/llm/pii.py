"""PII: validated seeds, the words before them as patterns, and what high-confidence patterns find besides."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphtables.llm.common import pick, read, settled

#: In the order in which kinds of one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: The base forms. Runs are possessive and begin where a run does, or where the last match ended, so that a long run
#: is read once; the matches are those of the plain forms.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be searched for the form at all.
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A part of up to 255, of which the form says that it has a digit.
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
IP = rf"^{_PART}(?:\.{_PART}){{3}}$"
#: Anything like an identifier, whole: an address without a dotted host, four numbers with dots, or digits with single
#: blanks, dots, hyphens or brackets between them, with the letters that stick to their end.
TOKEN = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
    r"|(?<![0-9A-Za-z])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++(?![0-9A-Za-z_@])"
    r"|(?<![0-9A-Za-z])\+?+\(?+[0-9](?:(?:[\x20.-]|\)[\x20-]?+|[\x20-]\()?+[0-9])*+[0-9A-Za-z_@]*+"
)
#: The word before a match, of the reversed text before it: all blanks are passed, however many.
BEFORE = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"
#: Matches whose places are found in one go; the places of such runs follow from their lengths.
RUN = 32

SPAN = "struct<start:bigint,k:int,end:bigint,hit:string,left:string>"


def _matches(text: Column, form: str, hint: str | None) -> Column:
    """The pieces between matches and the matches, by turns: where each match lies follows from their lengths."""
    zipped = F.arrays_zip(F.split(text, form, -1).alias("gap"), F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("hit"))
    none = F.array().cast("array<struct<gap:string,hit:string>>")
    return zipped if hint is None else F.when(F.contains(text, F.lit(hint)), zipped).otherwise(none)


def _before(gap: Column) -> Column:
    return F.lower(F.reverse(F.regexp_extract(F.reverse(gap), BEFORE, 1)))


def _placed(pieces: Column, k: int, wanted) -> Column:
    """start, kind, end (code points, end exclusive), text and the word before, of each wanted match.

    All matches move the place, but only wanted ones are put down. Arrays that grow are copied at every step, so this is
    done for RUN matches at a time, from places that are summed over runs.
    """
    n_runs = F.ceil(F.size(pieces) / RUN).cast("int")
    numbers = F.when(n_runs > 0, F.sequence(F.lit(0), n_runs - 1)).otherwise(F.array().cast("array<int>"))
    runs = F.transform(numbers, lambda i: F.slice(pieces, i * RUN + 1, RUN))
    zero = F.lit(0).cast("bigint")
    length = lambda p: (F.length(p["gap"]) + F.coalesce(F.length(p["hit"]), F.lit(0))).cast("bigint")
    sums = F.transform(runs, lambda run: F.aggregate(run, zero, lambda n, p: n + length(p)))
    first_of = F.aggregate(
        sums,
        F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"],
    )

    def step(acc, piece):
        first = acc["at"] + F.length(piece["gap"])
        end = first + F.length(piece["hit"])
        span = F.struct(
            first.alias("start"), F.lit(k).alias("k"), end.alias("end"), piece["hit"].alias("hit"), _before(piece["gap"]).alias("left")
        )
        out = F.when(wanted(piece["hit"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        more = F.struct(end.alias("at"), out.alias("out"))
        return F.when(piece["hit"].isNull(), acc).otherwise(more)

    none = F.array().cast(f"array<{SPAN}>").alias("out")
    spans = F.zip_with(runs, first_of, lambda run, at: F.aggregate(run, F.struct(at.alias("at"), none), step, lambda acc: acc["out"]))
    return F.flatten(spans)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def step(total, i):
        d = F.substring(back, i + 1, F.lit(1)).cast("int") * (1 + i % 2)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    return {
        "email": F.lit(True),
        "ip": hit.rlike(IP),
        "card": F.when(n.between(14, 19), _luhn(_digits(hit))).otherwise(False),
        "phone": n.between(10, 15),
    }[kind]


def _base(kind: str, k: int) -> Column:
    return _placed(F.col(kind), k, lambda hit: _valid(kind, hit)).alias(kind)


def _number_of(spans: Column, k: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["k"] == k)).cast("bigint")


def _loose_kind(hit: Column) -> Column:
    """The kind that a token has the outline of, or null."""
    n = F.length(_digits(hit))
    return (
        F.when(hit.rlike("^[^@]++@[^@]++$"), KINDS.index("email"))
        .when(hit.rlike("[A-Za-z_@]"), None)
        .when(hit.rlike(r"^[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++$"), KINDS.index("ip"))
        .when(n.between(12, 19) & ~hit.rlike(r"[+().]"), KINDS.index("card"))
        .when(n.between(7, 15), KINDS.index("phone"))
    )


def scan(rows: DataFrame) -> DataFrame:
    """id, tag, base, loose, other: the valid base matches, tokens with the outline of a kind (some are base matches or
    overlap them), and the words before tokens without one."""
    step = rows.select(
        "id", "tag",
        *[_matches(F.col("text"), FORMS[kind], HINT[kind]).alias(kind) for kind in KINDS],
        _matches(F.col("text"), TOKEN, None).alias("token"),
    )
    loose = _placed(F.col("token"), -1, lambda hit: _loose_kind(hit).isNotNull())
    plain = F.filter("token", lambda p: p["hit"].isNotNull() & _loose_kind(p["hit"]).isNull())
    other = F.filter(F.transform(plain, lambda p: _before(p["gap"])), lambda left: left != "")
    step = step.select("id", "tag", *[_base(kind, k) for k, kind in enumerate(KINDS)], loose.alias("loose"), other.alias("other"))
    return step.select("id", "tag", F.array_sort(F.concat(*KINDS)).alias("base"), "loose", "other")


def free(scanned: DataFrame) -> DataFrame:
    """id, tag, k, start, end, hit, left of the tokens that overlap no base span, once for rows that repeat id and text.

    Of the base spans that start no later, one must not end within the token; of those that start no earlier, none
    before it ends: two running values over the spans of a document in their order.
    """
    some = scanned.where(F.size("loose") > 0)
    spans = some.select("id", "tag", F.explode("loose").alias("s"), F.lit(False).alias("base")).union(
        some.select("id", "tag", F.explode("base").alias("s"), F.lit(True).alias("base"))
    ).select("id", "tag", "base", "s.*")
    of = Window.partitionBy("id", "tag")
    return (
        spans.withColumn("reached", F.max(F.when(F.col("base"), F.col("end"))).over(of.orderBy("start")))
        .withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(of.orderBy(F.desc("start"))))
        .where("NOT base AND coalesce(reached, 0) <= start AND (next IS NULL OR next >= end)")
        .select("id", "tag", _loose_kind(F.col("hit")).alias("k"), "start", "end", "hit", "left")
        .dropDuplicates(["id", "tag", "start"])
    )


def patterns(scanned: DataFrame, loose: DataFrame, rounds: int, least_support: float, least_score: float) -> DataFrame:
    """k, left, score of the patterns (a kind and the word before) that are accepted.

    The graph joins patterns with the distinct identifiers that follow them. Base matches are the seeds and count 1,
    tokens 0 at first. A pattern's support is the sum over its identifiers; contrary to it are the identifiers of other kinds
    and the tokens of no kind after the same word. Tokens of its own kind that are not known yet speak neither for nor
    against it. Its score is support / (support + contrary + 1), and it is accepted with enough of both. In the next round the
    tokens after accepted patterns count the best score of these, so that they can bring in patterns without a
    seed; it ends when no pattern is new, after ``rounds`` at the latest.
    """
    seeds = scanned.select(F.explode("base").alias("s")).select("s.k", "s.left", "s.hit", F.lit(1.0).alias("own"))
    graph = seeds.union(loose.select("k", "left", "hit", F.lit(0.0))).where("left != ''").groupBy("k", "left", "hit").agg(F.max("own").alias("own"))
    # an identifier that was validated anywhere is a seed everywhere
    known = graph.groupBy("k", "hit").agg(F.max("own").alias("known"))
    graph = settled(graph.join(known, ["k", "hit"]).select("k", "left", "hit", F.col("known").alias("own")), "graph")
    every = graph.groupBy("left", "k").agg(F.count(F.lit(1)).alias("n")).union(
        scanned.select(F.explode("other").alias("left")).groupBy("left").agg(F.lit(-1).alias("k"), F.count(F.lit(1)).alias("n"))
    )
    contrary = every.groupBy("left").agg(F.sum("n").alias("n"))
    sizes = every.where("k >= 0").withColumnRenamed("n", "own_n").join(contrary, "left")
    sizes = settled(sizes.select("k", "left", (F.col("n") - F.col("own_n")).alias("contrary")), "contrary")
    scored, accepted, before = graph.withColumnRenamed("own", "known"), None, -1
    for _ in range(rounds):
        support = scored.groupBy("k", "left").agg(F.sum("known").alias("support"))
        score = F.col("support") / (F.col("support") + F.col("contrary") + 1)
        accepted = support.where(F.col("support") >= least_support).join(sizes, ["k", "left"]).select("k", "left", score.alias("score"))
        accepted = settled(accepted.where(F.col("score") >= least_score), "patterns")
        now = accepted.count()
        if now == before:
            break
        before = now
        best = graph.join(accepted, ["k", "left"]).groupBy("k", "hit").agg(F.max("score").alias("best"))
        scored = graph.join(best, ["k", "hit"], "left").select("k", "left", "hit", F.greatest("own", F.coalesce("best", F.lit(0.0))).alias("known"))
    return accepted


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 6,
    least_support: float = 3.0,
    least_score: float = 0.7,
) -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found.

    ``found`` is an array of start, kind, end (code points, end exclusive) and base (whether the span has a valid base
    form or was discovered), sorted; ``spans`` lists kind:start:end of all, joined by commas; the counts and base_sha256
    are of the base alone. Valid base matches are the seeds. Accepted patterns (see ``patterns``) add the tokens that
    follow them, have the outline of their kind and overlap no base span: addresses without a dotted host, four numbers
    above 255, 12 to 19 digits in groups, 7 to 15 digits with brackets, dots, blanks or hyphens.

    Null counts as empty; empty texts and tables give no spans and no rows. Rows that repeat id and text are one document
    for the graph, and each comes out. Spans of one start (ties) are listed by kind. Other columns of ``docs`` are not looked
    at, whatever their names. All is done by built-in functions; the texts are read once and never shuffled, later steps
    move matches only. Work grows in proportion to the text, also where it holds nothing but matches.
    """
    rows = pick(docs, id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    scanned = settled(scan(rows.select("id", F.xxhash64(text).alias("tag"), text.alias("text"))), "scanned")
    loose = settled(free(scanned), "loose")
    sure = patterns(scanned, loose, rounds, least_support, least_score)
    new = loose.join(sure.select("k", "left"), ["k", "left"]).groupBy("id", "tag").agg(
        F.collect_set(F.struct("start", "k", "end", F.lit(False).alias("base"))).alias("new")
    )
    new = new.withColumnsRenamed({"id": "new_id", "tag": "new_tag"})
    base = F.transform("base", lambda s: F.struct(s["start"], s["k"], s["end"], F.lit(True).alias("base")))
    none = F.array().cast("array<struct<start:bigint,k:int,end:bigint,base:boolean>>")
    out = scanned.select("id", "tag", base.alias("base")).join(
        new, F.col("id").eqNullSafe(F.col("new_id")) & (F.col("tag") == F.col("new_tag")), "left"
    )
    every = F.array_sort(F.concat("base", F.coalesce("new", none)))
    return out.select(
        F.col("id").alias(id_col),
        *[_number_of(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
        every.alias("found"),
    )


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def op5_personal_data(spark, sf_dir):
    return personal_data(read(spark, sf_dir, "documents")).drop("found")


QUERIES = {"op5_personal_data": op5_personal_data}
ORACLE: dict[str, str] = {}
