"""Benchmark decontamination by template windows (operator 2). DataFrame functions only.

Numbers, names and units become typed placeholders, so that a question whose parameters were
changed keeps its template. Windows of eight template tokens are joined by hash. Along each
alignment of a document with an item, every value of the item's slots must map to one value of
the document's; windows of inconsistent alignments do not count. What is a name is decided by
capitals, so every window is also joined by its words in one case, with its values kept, and
counts if either join finds it. Other capitals and other parameters at once are not matched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

WINDOW = 8
#: A window with fewer plain words than this says too little; it is matched with its values kept.
PLAIN_WORDS = 4
#: Share of an item's windows that a document must hold.
COVERAGE = 0.25
#: Keys of a benchmark are broadcast up to so many bytes; beyond, a bitmap of them leaves few rows for a shuffled join.
BROADCAST_BYTES = 32 << 20

NAME, NUMBER, UNIT = "¤", "¦", "¬"
#: Stands for a point, comma or stroke between two digits, so that 12.5, 1,200 and 3/4 are one number each.
POINT = "¸"
#: Words that are numbers; up to four in a row, or after digits, are one.
SPELLED = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half"
).split()
_RUN = f"({NUMBER}[^ ]+) {NUMBER}([a-z]+)(?: {NUMBER}([a-z]+))?(?: {NUMBER}([a-z]+))?"
#: Words that are units after a number.
UNITS = (
    "percent dollar dollars euro euros pound pounds cent cents mg g kg gram grams kilogram kilograms ton tons ounce ounces lb lbs "
    "mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres mile miles inch inches foot feet yard yards "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years"
).split()
_SIGNS = (("%", " percent "), ("$", " dollars "), ("€", " euros "), ("£", " pounds "))


def marked(text: Column) -> Column:
    """Lower-case words between single spaces; each name, number and unit after a number bears its mark."""
    out = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT + POINT, "    ")
    # A capital after a lower-case letter, comma or the like begins a name; after a full stop it need not.
    out = F.regexp_replace(out, "([\\p{Ll},;:]) (\\p{Lu})", f"$1 {NAME}$2")
    out = F.lower(out)
    for sign, word in _SIGNS:
        out = F.replace(out, F.lit(sign), F.lit(word))
    out = F.regexp_replace(out, "(?<=[0-9])[.,/](?=[0-9])", POINT)
    out = F.regexp_replace(out, f"([0-9{POINT}]+)", f" {NUMBER}$1 ")
    out = F.trim(F.regexp_replace(out, f"[^\\p{{L}}\\p{{N}}{NAME}{NUMBER}{POINT}]+", " "))
    out = F.regexp_replace(out, f"(^| )({'|'.join(SPELLED)})(?= |$)", f"$1{NUMBER}$2")
    out = F.regexp_replace(out, _RUN, "$1$2$3$4")
    return F.regexp_replace(out, f"({NUMBER}[^ ]+) ({'|'.join(UNITS)})( |$)", f"$1 {UNIT}$2$3")


def _marks(word: Column) -> Column:
    return F.substring(word, 1, 1).isin(NAME, NUMBER, UNIT)


def template(words: Column) -> Column:
    """The tokens of marked words: a mark alone for a name, number or unit."""
    return F.transform(words, lambda w: F.when(_marks(w), F.substring(w, 1, 1)).otherwise(w))


def folded(mark: Column) -> Column:
    """A marked text without its marks, in one case whatever its capitals were."""
    return F.upper(F.translate(mark, NAME + NUMBER + UNIT, ""))


def _plain(words: Column) -> Column:
    return F.transform(words, folded)


def _step(width: int) -> int:
    return max(width // 2, 1)


def _hashed(rows: DataFrame) -> DataFrame:
    """rows (with mark) with words, n, and the hashes of their template tokens and of their words in one case."""
    rows = rows.withColumn("words", F.split("mark", " ")).withColumn("n", F.size("words"))
    rows = rows.withColumn("__tokens", F.transform(template(F.col("words")), lambda x: F.xxhash64(x)))
    return rows.withColumn("__plain", F.transform(F.split(folded(F.col("mark")), " "), lambda x: F.xxhash64(x))).drop("mark")


def _of_template(pos: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), F.slice("__tokens", pos + 1, size))


def _of_plain(pos: Column, size: int) -> Column:
    return F.xxhash64(F.lit(-size), F.slice("__plain", pos + 1, size))


def _starts(width: int, step: int) -> Column:
    return F.sequence(F.lit(0), F.col("n") - (width - _step(width) + 1), F.lit(step))


def _grams(rows: DataFrame, width: int, step: int) -> DataFrame:
    """rows with words, n, and grams: pos, of_template and of_plain, hashes of so many tokens from each multiple of the step on.

    Each window holds the first token of just one gram at a multiple of its own step, and that whole
    gram. A sequence shorter than a window has one gram, the whole.
    """
    size = width - _step(width) + 1
    gram = lambda pos, n: F.struct(pos.cast("int").alias("pos"), _of_template(pos, n).alias("of_template"), _of_plain(pos, n).alias("of_plain"))
    rows = _hashed(rows)
    grams = F.when(F.col("n") < width, F.array(gram(F.lit(0), width))).otherwise(F.transform(_starts(width, step), lambda p: gram(p, size)))
    return rows.withColumn("grams", grams).drop("__tokens", "__plain")


def may_hold(docs: DataFrame, own: DataFrame, width: int, small: bool) -> DataFrame:
    """text_key and mark of the texts of docs with a gram of the items' keys, and few others. No text moves."""
    size, step = width - _step(width) + 1, _step(width)
    texts = docs.select("doc_id", "text", text_key(F.col("doc_id"), F.col("text")).alias("text_key"))
    rows = _hashed(texts.select("text_key", marked(F.col("text")).alias("mark")))
    whole = F.array(_of_template(F.lit(0), width), _of_plain(F.lit(0), width))
    starts = _starts(width, step)
    every = F.concat(F.transform(starts, lambda p: _of_template(p, size)), F.transform(starts, lambda p: _of_plain(p, size)))
    hashes = rows.select("text_key", F.explode(F.when(F.col("n") < width, whole).otherwise(every)).alias("h"))
    hit = hashes.join(F.broadcast(own.select("h").distinct()), "h", "left_semi") if small else shared.passing(hashes, "h", own.select("h"))
    found = shared.written(hit.select("text_key").distinct(), "candidates")
    return shared.passing(texts, "text_key", found)


def item_keys(items: DataFrame, width: int) -> DataFrame:
    """What a document is joined on: h, the grams of each window by its template, if it is rich, and by its words in one case."""
    at = _grams(items, width, 1)
    at = at.withColumn("item_pos", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - width, F.lit(0)))))
    at = at.withColumn("item_words", F.slice("words", F.col("item_pos") + 1, width))
    rich = F.size(F.filter("item_words", lambda x: ~_marks(x))) >= F.least(F.lit(PLAIN_WORDS), F.col("n"))
    own = F.filter("grams", lambda g: g["pos"].between(F.col("item_pos"), F.col("item_pos") + _step(width) - 1))
    at = at.select("item_id", "item_pos", rich.alias("rich"), "item_words", template(F.col("item_words")).alias("item_tokens"), _plain(F.col("item_words")).alias("item_plain"), F.explode(own).alias("g"))
    key = lambda copied, h: F.struct(F.lit(copied).alias("copied"), h.alias("h"))
    keys = F.array(key(True, F.col("g.of_plain")), key(False, F.when(F.col("rich"), F.col("g.of_template"))))
    return at.withColumn("offset", F.col("g.pos") - F.col("item_pos")).select("*", F.inline(keys)).drop("g").where("h IS NOT NULL")


def text_keys(texts: DataFrame, width: int) -> DataFrame:
    """texts (doc_id, text_hash, text_key, mark) exploded to pos, h and near: the grams at multiples of the step, with the words around.

    A row holds the words of the windows that its gram may stand for, never the whole text.
    """
    step = _step(width)
    rows = _grams(texts, width, step)
    near = lambda pos: F.slice("words", F.greatest(pos - (step - 1), F.lit(0)) + 1, width + step - 1)
    keyed = F.transform("grams", lambda g: F.struct(g["pos"].alias("pos"), F.array(g["of_template"], g["of_plain"]).alias("hs"), near(g["pos"]).alias("near")))
    return rows.select("doc_id", "text_hash", "text_key", F.inline(keyed)).select("doc_id", "text_hash", "text_key", "pos", "near", F.explode("hs").alias("h"))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """One row for each text of docs and item of benchmark that it holds: doc_id, text_hash, text_key, item_id, n_windows, coverage, exact.

    coverage is the share of the item's windows found along consistent alignments if that is at
    least the given share; else the share found so or with the same words in whatever case, which
    must reach it. exact says whether all slots kept their values. Items with fewer words than width
    match documents that consist of them alone. Null and empty texts match nothing; repeated rows
    of docs give one row; repeated items with the same id count as one. Other columns are ignored.
    """
    items = benchmark.select(F.col("item_id").alias("item_id"), marked(F.col("text")).alias("mark")).where("mark <> ''").distinct()
    own = item_keys(items, width)
    length = lambda words: F.length(F.array_join(words, " ")) + 16 * F.size(words)
    held = own.agg(F.sum(length("item_words") + length("item_tokens") + length("item_plain") + 64)).first()[0]
    small = (held or 0) <= BROADCAST_BYTES
    # First the texts that share any gram, by hashes alone; only these are compared word by word.
    some = may_hold(docs, own, width, small)
    texts = some.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text_key", marked(F.col("text")).alias("mark"))
    keys = text_keys(texts, width)
    if small:
        own = F.broadcast(own)
    else:
        keys = shared.passing(keys, "h", own.select("h"))
    theirs = F.slice("near", F.least(F.col("pos"), F.lit(_step(width) - 1)) - F.col("offset") + 1, width)
    both = keys.join(own, "h").where("pos >= offset").withColumn("theirs", theirs)
    both = both.where(F.when(F.col("copied"), _plain(F.col("theirs")) == F.col("item_plain")).otherwise(template(F.col("theirs")) == F.col("item_tokens")))
    # A window of few plain words belongs to its alignment when its values are marked alike.
    aligned = ~F.col("copied") | (~F.col("rich") & (F.col("theirs") == F.col("item_words")))
    shift = F.col("pos") - F.col("offset") - F.col("item_pos")
    found = both.select("doc_id", "text_hash", "text_key", "item_id", "item_pos", "copied", shift.alias("shift"), aligned.alias("aligned"), F.arrays_zip("theirs", F.col("item_words").alias("ours")).alias("pairs"))
    total = items.groupBy("item_id").agg(F.sum(F.greatest(F.size(F.split("mark", " ")) - (width - 1), F.lit(1))).alias("of_item"))
    slots = F.filter("pairs", lambda p: _marks(p["ours"]))
    of_text = ("doc_id", "text_hash", "text_key", "item_id")
    lines = found.groupBy(*of_text, "shift").agg(
        F.collect_set(F.when(F.col("aligned"), F.col("item_pos"))).alias("along"),  # at most the item's windows
        F.collect_set(F.when(F.col("copied"), F.col("item_pos"))).alias("copies"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("aligned"), slots)))).alias("slots"),
    )
    ours = F.array_distinct(F.transform("slots", lambda p: p["ours"]))
    one_value = F.size(ours) == F.size("slots")
    none = F.array().cast("array<int>")
    by_line = lines.select(*of_text, F.when(one_value, F.col("along")).otherwise(none).alias("along"), "copies", F.forall("slots", lambda p: p["ours"] == p["theirs"]).alias("exact"))
    gathered = lambda name: F.array_distinct(F.flatten(F.collect_list(name)))
    exact = F.coalesce(F.bool_and(F.when(F.size("along") > 0, F.col("exact"))), F.lit(True))
    summed = by_line.groupBy(*of_text).agg(gathered("along").alias("along"), gathered("copies").alias("copies"), exact.alias("exact")).join(total, "item_id")
    aligned_alone = F.size("along").cast("long")
    n = F.when(aligned_alone / F.col("of_item") >= coverage, aligned_alone).otherwise(F.size(F.array_union("along", "copies")).cast("long"))
    share = F.col("n_windows") / F.col("of_item")
    return summed.withColumn("n_windows", n).where(share >= coverage).select("doc_id", "text_hash", "text_key", "item_id", "n_windows", share.alias("coverage"), "exact")


def text_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows whose text holds a benchmark item; columns as they were."""
    found = leaks(docs, benchmark, **options).select(F.col("text_key").alias("__key"))
    return shared.without(docs, text_key(F.col("doc_id"), F.col("text")), found)


def op2_template_windows(spark, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, as doc_id and item_id, over all whole texts.

    Null and empty texts, and items without words, match nothing; repeated rows and items give one
    row; a null doc_id is kept as it is. Time and memory grow in proportion to a text's length.
    Without documents or items there are no rows. Other columns are ignored.
    """
    docs, benchmark = shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark")
    return leaks(docs, benchmark).select("doc_id", "item_id", "n_windows", F.round("coverage", 6).alias("coverage"), "exact")


def oracle(width: int = WINDOW, coverage: float = COVERAGE, source: str = "documents") -> str:
    """DuckDB SQL for leaks() of documents against benchmark, of the columns that the query returns."""
    marks = f"[{NAME}{NUMBER}{UNIT}]"

    def mark(text: str) -> str:
        out = f"translate(coalesce({text}, ''), '{NAME + NUMBER + UNIT + POINT}', '    ')"
        out = f"lower(regexp_replace({out}, '([\\p{{Ll}},;:]) (\\p{{Lu}})', '\\1 {NAME}\\2', 'g'))"
        for sign, word in _SIGNS:
            out = f"replace({out}, '{sign}', '{word}')"
        for _ in range(2):  # the digit after a point may be the one before the next
            out = f"regexp_replace({out}, '([0-9])[.,/]([0-9])', '\\1{POINT}\\2', 'g')"
        out = f"regexp_replace({out}, '([0-9{POINT}]+)', ' {NUMBER}\\1 ', 'g')"
        out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}{NAME}{NUMBER}{POINT}]+', ' ', 'g'))"
        out = f"regexp_replace(replace(' ' || {out} || ' ', ' ', '  '), ' ({'|'.join(SPELLED)}) ', ' {NUMBER}\\1 ', 'g')"
        out = f"trim(regexp_replace({out}, ' +', ' ', 'g'))"
        out = f"regexp_replace({out}, '{_RUN}', '\\1\\2\\3\\4', 'g')"
        return f"regexp_replace({out}, '({NUMBER}[^ ]+) ({'|'.join(UNITS)})( |$)', '\\1 {UNIT}\\2\\3', 'g')"

    def windowed(name: str, ident: str) -> str:
        return f"""{name} AS (SELECT {ident}, pos, words[pos + 1 : pos + {width}] raw, tokens[pos + 1 : pos + {width}] tmpl, folded[pos + 1 : pos + {width}] plain
            FROM (SELECT *, unnest(range(greatest(len(words) - {width - 1}, 1))) pos FROM
                (SELECT {ident}, string_split(m, ' ') words, string_split(regexp_replace(m, '({marks})[^ ]+', '\\1', 'g'), ' ') tokens,
                    string_split(upper(translate(m, '{NAME + NUMBER + UNIT}', '')), ' ') folded FROM {name}_m WHERE m <> '')))"""

    return f"""
    WITH d_m AS (SELECT doc_id, hash(coalesce(text, '')) th, {mark('text')} m FROM {source}),
    b_m AS (SELECT DISTINCT item_id, {mark('text')} m FROM benchmark),
    {windowed('d', 'doc_id, th')},
    {windowed('b', 'item_id')},
    b2 AS (SELECT *, len(list_filter(raw, lambda x: NOT regexp_matches(x, '^{marks}'))) >= least({PLAIN_WORDS}, len(raw)) rich FROM b),
    total AS (SELECT item_id, count(*) of_item FROM b GROUP BY 1),
    found AS (SELECT d.doc_id, d.th, b2.item_id, b2.pos ipos, d.pos - b2.pos shift, d.raw theirs, b2.raw ours, false copied, true aligned FROM d JOIN b2 ON d.tmpl = b2.tmpl AND b2.rich
        UNION ALL SELECT d.doc_id, d.th, b2.item_id, b2.pos, d.pos - b2.pos, d.raw, b2.raw, true, NOT b2.rich AND d.raw = b2.raw FROM d JOIN b2 ON d.plain = b2.plain),
    hits AS (SELECT *, list_filter(list_zip(theirs, ours), lambda p: regexp_matches(p[2], '^{marks}')) slots FROM found),
    lines AS (SELECT doc_id, th, item_id, shift, coalesce(list(DISTINCT ipos) FILTER (aligned), []) along, coalesce(list(DISTINCT ipos) FILTER (copied), []) copies,
        list_distinct(flatten(coalesce(list(slots) FILTER (aligned), []))) slots FROM hits GROUP BY 1, 2, 3, 4),
    good AS (SELECT doc_id, th, item_id, copies, len(list_filter(slots, lambda p: p[1] <> p[2])) = 0 exact,
        CASE WHEN len(list_distinct(list_transform(slots, lambda p: p[2]))) = len(slots) THEN along ELSE [] END along FROM lines),
    summed AS (SELECT doc_id, th, item_id, list_distinct(flatten(list(along))) along, list_distinct(flatten(list(copies))) copies,
        coalesce(bool_and(exact) FILTER (len(along) > 0), true) exact FROM good GROUP BY 1, 2, 3),
    sized AS (SELECT doc_id, item_id, exact, of_item, CASE WHEN len(along) / of_item >= {coverage} THEN len(along) ELSE len(list_distinct(list_concat(along, copies))) END n_windows
        FROM summed JOIN total USING (item_id))
    SELECT doc_id, item_id, n_windows, round(n_windows / of_item, 6) AS coverage, exact FROM sized WHERE n_windows / of_item >= {coverage}"""
