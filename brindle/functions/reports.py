"""Scalar rules over the texts of inspection reports, as column expressions inside the engine.

Every rule is total: null counts as the empty text unless stated otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from brindle.functions import text as base
from brindle.functions import vocabulary as V

EDGE = "，,；;。． "


def contains_any(x: Column, words: Sequence[str]) -> Column:
    """Whether a text holds one of the words; one scan."""
    return x.rlike("|".join(f"\\Q{w}\\E" for w in words))


def compact(x: Column) -> Column:
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", "")


def display(x: Column) -> Column:
    """Runs of white space, wide ones too, are one blank; none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)[\s\x{3000}]+", " "))


def stripped(x: Column, chars: str = EDGE) -> Column:
    return F.btrim(x, F.lit(chars))


def sentences(x: Column) -> Column:
    """The distinct sentences of a text in order, without marks at their ends."""
    parts = F.transform(F.split(display(x), "(?<=[。；;！？!?])"), lambda s: stripped(s))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))


# ---- titles and names


def title_key(x: Column) -> Column:
    """A title without white space and leading numbering, marks in half width."""
    return F.regexp_replace(F.translate(compact(x), "．（）：", ".():"), V.NUMBERING, "")


def clean_name(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)[\s\x{a0}]+", " "))


def name_key(x: Column, endings: Sequence[str] = V.LABEL_ENDINGS) -> Column:
    """The identity of a file name: all label endings off, then letters, digits and ideographs only."""
    whole = clean_name(x)
    bare = F.regexp_replace(whole, r"(?:[ _．。-]*(?:" + "|".join(endings) + "))+$", "")
    named = F.when(bare != whole, F.btrim(bare, F.lit(" -_．。"))).otherwise(whole)
    return F.regexp_replace(F.lower(named), r"[^0-9a-z\x{4e00}-\x{9fff}]+", "")


def aliases(path: Column) -> Column:
    """The names under which a file may be asked for: whole path, name, stem, and parent with stem."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(path), r"\\", "/"), r"^(\./)+", "")
    name = F.element_at(F.split(clean, "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    parent = F.try_element_at(F.split(clean, "/"), F.lit(-2))
    return F.array_distinct(F.array_compact(F.array(clean, name, stem, F.concat_ws("/", parent, stem))))


def same_path(a: Column, b: Column) -> Column:
    """Whether two paths are one, or one ends the other after a slash."""
    return (a != "") & (b != "") & ((a == b) | a.endswith(F.concat(F.lit("/"), b)) | b.endswith(F.concat(F.lit("/"), a)))


def facility(name: Column, endings: Sequence[tuple[str, str, str]] = V.FACILITIES) -> Column:
    """(raw_type, type, noun) by the first ending that a name has; empty texts for none."""
    x = compact(name)
    out = F.struct(*[F.lit("").alias(n) for n in ("raw_type", "type", "noun")])
    for raw, kind, noun in reversed(endings):
        out = F.when(x.endswith(raw), F.struct(F.lit(raw).alias("raw_type"), F.lit(kind).alias("type"), F.lit(noun).alias("noun"))).otherwise(out)
    return out


def filename_grades(stem: Column) -> Column:
    """(previous, current) as a file name marks them with 原 and 现; the last of each counts."""
    letter = lambda label: F.upper(F.try_element_at(F.regexp_extract_all(stem, F.lit(f"{label}\\s*([A-Ea-e一二三四五六])"), F.lit(1)), F.lit(-1)))
    graded = lambda g: F.when(g.rlike("^[A-E]$"), F.concat(g, F.lit("级"))).when(g.isNotNull(), F.concat(g, F.lit("类")))
    return F.struct(graded(letter("原")).alias("previous"), graded(letter("现")).alias("current"))


# ---- display forms


def description(x: Column, keep_figures: Column | None = None) -> Column:
    """A defect's description without a unit note and, unless kept, without figure references at its end."""
    word = V.FIGURE_WORD
    figures = rf"[，,；;。\s]+(?:详见|参见|见)?\s*{word}\s*{V.FIGURE_NO}(?:\s*[、,，及和至~～\-]\s*(?:{word}\s*)?{V.FIGURE_NO})*\s*[）)]?\s*[。．.]?$"
    plain = stripped(F.regexp_replace(display(x), V.UNIT_NOTE, ""))
    short = stripped(F.regexp_replace(plain, figures, ""))
    return short if keep_figures is None else F.when(keep_figures, plain).otherwise(short)


def defect_type(x: Column) -> Column:
    """Several types in one cell are parted by 、."""
    return stripped(F.regexp_replace(F.regexp_replace(display(x), r"\s*[,，/＋+]\s*", "、"), "、+", "、"), "、" + EDGE)


def item_text(x: Column) -> Column:
    """A recommendation without the label of its place in a list."""
    return F.trim(F.regexp_replace(display(x), V.ITEM_LABEL, ""))


def trend(x: Column, components: Sequence[str] = V.COMPONENTS) -> Column:
    """The clauses of a trend, distinct and in order: component first, 新增 in plain words, 、 between items."""
    whole = stripped(display(x))
    head = "^(" + "|".join(components) + r")\s*：\s*(.*)$"
    edge = "：" + EDGE

    def clause(raw: Column) -> Column:
        part = F.replace(raw, F.lit(":"), F.lit("："))
        content = stripped(F.regexp_extract(part, head, 2), edge)
        body = stripped(F.regexp_extract(content, r"^新增病害\s*：?\s*(.*)$", 1), edge)
        fresh = F.when(body.startswith("无"), F.concat(F.lit("无新增病害"), F.substring(body, 2, 1 << 30))).otherwise(F.concat(F.lit("新增"), F.regexp_replace(body, "^新增", "")))
        said = F.when(content.startswith("新增病害"), fresh).otherwise(content)
        said = F.replace(said, F.lit(","), F.lit("、"))
        named = F.concat_ws("：", F.regexp_extract(part, head, 1), F.when(said != "", said))
        return F.when(part.rlike(head), named).otherwise(F.replace(part, F.lit(","), F.lit("、")))

    parts = F.filter(F.transform(F.split(whole, "[；;]+"), lambda p: stripped(p)), lambda p: p != "")
    clauses = F.array_distinct(F.filter(F.transform(parts, clause), lambda c: c != ""))
    return F.when(whole.isin("", *V.NOTHING) | (F.size(clauses) == 0), whole).otherwise(F.array_join(clauses, "；"))


# ---- texts under a budget


def budget(items: Column, cap: int, total: int, least: int, most: int, glue: int = 1, distinct: bool = True) -> Column:
    """The leading items within ``total`` characters, each cut to ``cap``; the last one is cut where ``least`` characters still fit.

    ``glue`` is the length of what will stand between items.
    """
    tail = lambda x: F.regexp_replace(x, "[，,；; ]+$", "")

    def step(a: Column, x: Column) -> Column:
        whole = tail(F.left(x, F.lit(cap)))
        room = F.lit(total) - a["used"] - F.when(F.size(a["out"]) > 0, glue).otherwise(0)
        over = F.length(whole) > room
        stop = a["done"] | (over & (room < least))
        kept = F.when(over, tail(F.left(whole, F.greatest(room, F.lit(0))))).otherwise(whole)
        takes = ~stop & (kept != "")
        takes = takes & ~F.array_contains(a["out"], kept) if distinct else takes
        out = F.when(takes, F.array_append(a["out"], kept)).otherwise(a["out"])
        used = a["used"] + F.when(takes, F.length(kept) + F.when(F.size(a["out"]) > 0, glue).otherwise(0)).otherwise(0)
        return F.struct(out.alias("out"), used.alias("used"), (stop | (F.size(out) >= most) | ((used >= total) if glue else F.lit(False))).alias("done"))

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("used"), F.lit(False).alias("done"))
    return F.aggregate(items, start, step, lambda a: a["out"])


def before_action(x: Column) -> Column:
    """A statement without the advice that follows it; empty if it is advice from the start."""
    return F.when(x.rlike(V.ACTION_HEAD), F.lit("")).otherwise(stripped(F.element_at(F.split(x, V.ACTION_TAIL, 2), 1)))


def marks(x: Column) -> Column:
    return F.translate(x, ",:", "，：")


def overall_conclusion(x: Column, public: bool = True) -> Column:
    """At most four statements of 250 characters together that assess the whole or name a defect; advice and test detail are left out."""
    heard = F.filter(sentences(x), lambda s: ~contains_any(compact(s), V.NOISE))
    cut = before_action if public else lambda s: F.when(contains_any(compact(s), V.ACTIONS), stripped(F.element_at(F.split(s, r"[，,；;。]?\s*(?=" + "建议|应及时|需及时|维修|修复|修补|处治|处置|加固|更换|清理|养护|可直接用|环氧砂浆" + ")", 2), 1))).otherwise(s)
    said = F.filter(F.transform(heard, cut), lambda s: (s != "") & contains_any(compact(s), V.OVERALL + V.DEFECTS))
    return F.array_join(budget(F.transform(said, marks) if public else said, 180, 250, 24, 4), "；")


def has_consequence(x: Column) -> Column:
    return contains_any(x, V.STRONG_CONSEQUENCES) | x.rlike(V.IMPACT)


def risk_points(x: Column, public: bool = True) -> Column:
    """At most three statements of 200 characters together that join a defect to its consequence.

    The public form falls back on statements of defects alone where none names a consequence.
    """
    if not public:
        ok = lambda s: ~contains_any(s, V.NOISE + V.ACTIONS + V.MADE_UP) & ~s.rlike(V.PAST_WORK) & contains_any(s, V.DEFECTS) & contains_any(s, V.CONSEQUENCES)
        return F.array_join(budget(F.filter(sentences(x), lambda s: ok(compact(s))), 120, 200, 24, 3), "；")
    heard = F.filter(sentences(x), lambda s: ~contains_any(compact(s), V.NOISE + V.MADE_UP) & ~compact(s).rlike(V.PAST_WORK))
    cut = F.filter(F.transform(heard, before_action), lambda s: s != "")
    of_defects = F.filter(cut, lambda s: contains_any(compact(s), V.DEFECTS) & ~(contains_any(compact(s), V.CAUSES) & ~has_consequence(compact(s))))
    clean = lambda xs: F.array_distinct(F.filter(F.transform(xs, lambda s: F.regexp_replace(F.left(marks(s), F.lit(120)), "[，,；; ]+$", "")), lambda s: s != ""))
    strict = clean(F.filter(of_defects, lambda s: contains_any(compact(s), V.SPECIFIC_DEFECTS) & has_consequence(compact(s))))
    chosen = F.when(F.size(strict) > 0, strict).otherwise(clean(of_defects))
    return F.array_join(budget(chosen, 120, 200, 24, 3), "；")


def text_list(values: Column, kind: str) -> Column:
    """At most four statements of a list, each ending in 。; causes must name a cause, safety statements a consequence and no advice."""
    said = F.filter(F.transform(values, lambda v: F.regexp_replace(stripped(display(v)), r"^无[。.]\s*(?=本次检测)", "")), lambda s: (s != "") & ~contains_any(compact(s), V.MADE_UP))
    if kind == "cause":
        said = F.filter(said, lambda s: compact(s).rlike(V.CAUSE_PHRASE))
    if kind == "safety":
        said = F.filter(said, lambda s: ~contains_any(compact(s), V.ACTIONS) & contains_any(compact(s), V.CONSEQUENCES))
    kept = budget(said, 520, 900, 30, 4, glue=0, distinct=False) if kind == "detailed" else F.slice(said, 1, 4)
    return F.transform(kept, lambda s: F.concat(s, F.lit("。")))


# ---- classes


def first_of(x: Column, rules: Sequence[tuple[str, Sequence[str]]], otherwise: str | None) -> Column:
    """The label of the first rule one of whose words a text holds."""
    return F.coalesce(*[F.when(contains_any(x, ws), F.lit(label)) for label, ws in rules], F.lit(otherwise).cast("string"))


def safety_topic(x: Column) -> Column:
    return first_of(compact(x), V.SAFETY_TOPICS, "结构安全")


def safety_rank(x: Column) -> Column:
    """(rank, length): the lower, the better a statement settles its topic."""
    s = compact(x)
    score = sum((F.when(contains_any(s, ws), n).otherwise(0) for n, ws in V.SAFETY_RANK), F.lit(0))
    return F.struct((-score).alias("rank"), F.length(s).alias("length"))


def inferred_category(content: Column) -> Column:
    """The category that a recommendation's words imply, by the first rule that holds; null for none."""
    s = compact(content)
    has = lambda ws: contains_any(s, ws)
    soon, fast, routine = (F.lit(c) for c in V.CATEGORIES)
    routine_repair = has(V.ROUTINE_REPAIR) | (s.contains("其他常规缺陷") & s.contains("养护维修")) | (s.contains("参照") & has(V.STANDARDS) & ~has(V.NAMED_DEFECTS))
    return (
        F.when(s.rlike("立即(?:维修|修复|修|处置|处理|进行)") | has(V.SAFETY_RISK) | (s.contains("变形严重") & has(("立即", "更换"))), soon)
        .when(has(V.CLEANING) & has(V.CLOGGED), fast).when(routine_repair, routine).when(has(V.CONCRETE_REPAIR), fast).when(has(V.MONITORING), routine).when(has(V.LOOSE_REPAIR), fast)
    )


def settled_category(category: Column, content: Column) -> Column:
    """One of the three categories, always: the stated one, else by urgent words, repair words, or none."""
    raw, s = display(category), compact(content)
    return F.when(raw == V.CATEGORY_ALIAS[0], V.CATEGORY_ALIAS[1]).when(raw.isin(*V.CATEGORIES), raw).when(contains_any(s, V.URGENT_WORDS), V.CATEGORIES[0]).when(contains_any(s, V.REPAIR_WORDS), V.CATEGORIES[1]).otherwise(V.CATEGORIES[2])


def named_categories(x: Column) -> Column:
    """The distinct categories that a text names, the alias as what it stands for, in report order."""
    s = F.replace(compact(x), F.lit(V.CATEGORY_ALIAS[0]), F.lit(V.CATEGORY_ALIAS[1]))
    return F.array_compact(F.array(*[F.when(s.contains(c), F.lit(c)) for c in V.CATEGORIES]))


def resolved_category(hint: Column, content: Column, infer: bool = True) -> Column:
    """(category, unresolved): a hint must not contradict what the content names; inference may overrule it."""
    h, c = named_categories(hint), named_categories(content)
    inferred = inferred_category(content) if infer else F.lit(None).cast("string")
    clash = (F.size(h) > 1) | ((F.size(h) == 1) & (F.size(c) > 0) & (h != c)) | ((F.size(h) == 0) & (F.size(c) > 1))
    category = F.when(clash, "").when(F.size(h) == 1, F.coalesce(inferred, h[0])).when(F.size(c) == 1, c[0]).otherwise(F.coalesce(inferred, F.lit("")))
    return F.struct(category.alias("category"), (category == "").alias("unresolved"))


def counts_text(counts: Sequence[Column]) -> Column:
    """The summary line of the category counts, zeros included."""
    return F.concat_ws("、", *[F.concat(n.cast("string"), F.lit("条" + c)) for n, c in zip(counts, V.CATEGORIES, strict=True)])


def stated_counts(line: Column) -> Column:
    """Map of category to the count that a summary line states; a category stated twice adds up."""
    found = [F.aggregate(F.regexp_extract_all(F.replace(F.coalesce(line, F.lit("")), F.lit(V.CATEGORY_ALIAS[0]), F.lit(V.CATEGORY_ALIAS[1])), F.lit(rf"(\d{{1,18}})\s*条?\s*{c}"), F.lit(1)), F.lit(None).cast("long"), lambda a, n: F.coalesce(a, F.lit(0).cast("long")) + n.cast("long")) for c in V.CATEGORIES]
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, V.CATEGORIES)), F.array(*found)), lambda _, n: n.isNotNull())


def canonical_value(field: Column, value: Column) -> Column:
    """The form in which a field's values are compared: numbers plainly, grades in capitals without their unit, texts without marks."""
    x = compact(value)
    number = base.plain_number(F.regexp_replace(x, "分$", ""))
    grade = F.upper(F.regexp_replace(x, "[级类]$", ""))
    return F.when(field.endswith("_score"), number).when(field.endswith("_grade"), grade).otherwise(F.lower(F.regexp_replace(x, r"(?U)[\W_]+", "")))


def grade_by_mode(score: Column, reported: Column, generic: Column) -> Column:
    """The reported grade, or the generic band of the score where that mode is on; a class grade (X类) always stays."""
    banded = F.concat(base.grade(score), F.lit("级"))
    return F.when(compact(reported).endswith("类") | ~generic | banded.isNull(), F.coalesce(reported, F.lit(""))).otherwise(banded)
