"""SQL text pieces for the oracles (DuckDB dialect)."""

from tunewright import dims
from tunewright.functions.text import BLANK


def lit(v):
    return dims.quote(v)


def dbl(e):
    return f"CAST({e} AS DOUBLE)"


def strip(e):
    return f"regexp_replace({e}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def norm(e):
    return f"regexp_replace(lower({strip(f'coalesce({e}, chr(32))')}), '{BLANK}+', ' ', 'g')"


def words(e):
    """Distinct words of lower-cased text."""
    return f"list_distinct(list_filter(regexp_split_to_array({e}, '{BLANK}+'), lambda x: x <> ''))"


def r4(e):
    return f"round(CAST({e} AS DECIMAL(18,10)), 4)"


def amount4(e):
    return f"round(CAST({e} AS DECIMAL(38,10)), 4)"


def clamp(e):
    return f"greatest(CAST(0.001 AS DECIMAL(18,4)), least(CAST(0.999 AS DECIMAL(18,4)), CAST({e} AS DECIMAL(18,4))))"


def sql_list(items):
    return "[" + ", ".join(lit(i) for i in items) + "]"


def similarity(s, e):
    """Expects already normalised text expressions."""
    kw = sql_list(dims.CRITICAL_KEYWORDS)
    ew, sw = words(e), words(s)
    wanted = f"len(list_filter({kw}, lambda k: contains({e}, k)))"
    found = f"len(list_filter({kw}, lambda k: contains({e}, k) AND contains({s}, k)))"
    overlap = f"(CAST(len(list_intersect({sw}, {ew})) AS DOUBLE) / len({ew}))"
    recall = f"(CASE WHEN {wanted} > 0 THEN CAST({found} AS DOUBLE) / {wanted} ELSE 0.0::DOUBLE END)"
    return (f"CASE WHEN {s} = {e} THEN 1.0::DOUBLE WHEN len({ew}) = 0 THEN 0.0::DOUBLE "
            f"ELSE {dbl(r4(f'{overlap} * 0.4::DOUBLE + {recall} * 0.6::DOUBLE'))} END")


def hits(text, phrases):
    return f"len(list_filter({sql_list(phrases)}, lambda k: contains({text}, k)))"


def ladder(sim, steps):
    return "CASE " + " ".join(f"WHEN {sim} >= {a} THEN {c}" for a, c in steps) + " ELSE 0.0 END"


def location(s, e):
    ls, le = f"lower({strip(f'coalesce({s}, chr(32))')})", f"lower({strip(f'coalesce({e}, chr(32))')})"
    over = r4(f"CAST(len(list_intersect({words(ls)}, {words(le)})) AS DOUBLE) / len({words(le)}) * 0.10::DOUBLE")
    return (f"CASE WHEN coalesce({s}, '') = '' OR coalesce({e}, '') = '' THEN 0.0 WHEN {ls} = {le} THEN 0.15 "
            f"WHEN len({words(le)}) = 0 THEN 0.0 ELSE {over} END")


def error_type(s, e):
    ls, le = f"lower({strip(f'coalesce({s}, chr(32))')})", f"lower({strip(e)})"
    rel = " OR ".join(f"({le} = {lit(k)} AND {hits(ls, v)} > 0)" for k, v in dims.ERROR_TYPE_ALIASES.items())
    return (f"CASE WHEN coalesce({s}, '') = '' THEN 0.0 WHEN {ls} = {le} THEN 0.10 "
            f"WHEN {rel} THEN 0.05 ELSE 0.0 END")


def explanation(t):
    n = f"length({strip(f'coalesce({t}, chr(32))')})"
    return f"CASE WHEN {n} < 10 THEN 0.0 WHEN {n} < 30 THEN 0.05 WHEN {n} < 80 THEN 0.10 ELSE 0.15 END"


def confidence(t):
    return f"CASE WHEN TRY_CAST({strip(t)} AS DOUBLE) BETWEEN 0 AND 1 THEN 0.05 ELSE 0.0 END"


def longer(t, n, credit):
    return f"CASE WHEN length({strip(f'coalesce({t}, chr(32))')}) > {n} THEN {credit} ELSE 0.0 END"


def first_text(a, b):
    return f"coalesce(nullif({a}, ''), nullif({b}, ''), '')"


def total(*parts):
    return dbl(clamp(" + ".join(f"CAST({p} AS DECIMAL(18,4))" for p in parts)))


SAID = "coalesce(nullif(explanation, ''), nullif(change_made, ''), '')"


def grade_easy(p=""):
    sim = similarity("sub1", "want_norm")
    return total(ladder(f"({sim})", dims.FIX_LADDER["easy"]), location("error_location", "want_location"),
                 error_type("error_type", "want_type"), explanation(SAID), confidence("confidence"))


def grade_medium():
    sim = similarity("sub1", "want_norm")
    low = f"lower({SAID})"
    logic = (f"least(0.20, 0.05 * CASE WHEN want_type = 'performance' THEN {hits(low, dims.PERFORMANCE_KEYWORDS)} "
             f"ELSE {hits(low, dims.LOGIC_KEYWORDS)} END)")
    return total(ladder(f"({sim})", dims.FIX_LADDER["medium"]), logic, location("error_location", "want_location"),
                 explanation(SAID), confidence("confidence"), longer("impact", 20, 0.05))


def grade_hard():
    sim = similarity("sub2", "want_norm")
    said = f"lower({SAID} || ' ' || coalesce(optimization_type, ''))"
    arms = " ".join(
        f"WHEN {hits('lower(want_issue)', keys)} > 0 THEN least(0.30, 0.06 * {hits(said, phrases)})"
        for keys, phrases in dims.CONCEPTS)
    return total(ladder(f"({sim})", dims.FIX_LADDER["hard"]), f"CASE {arms} ELSE 0.0 END",
                 explanation(SAID), longer("root_cause", 30, 0.10),
                 longer("expected_improvement", 20, 0.10), confidence("confidence"))


CASE_VALUES = "(VALUES " + ", ".join(
    "(" + ", ".join(lit(c[k]) for k in ("id", "fixed_query", "error_location", "error_type", "issue_type", "category",
                                        "buggy_query", "error_message")) + ")"
    for c in dims.CASES) + ") cases(case_id, want_query, want_location, want_type, want_issue, category, buggy, message)"


def graded(source):
    """Submissions joined to their case and graded; task_id decides the grader."""
    return f"""
joined AS (SELECT s.*, c.*, {norm(first_text('s.fixed_query', 's.optimized_query'))} AS sub1,
                  {norm(first_text('s.optimized_query', 's.fixed_query'))} AS sub2, {norm('c.want_query')} AS want_norm
           FROM {source} s LEFT JOIN {CASE_VALUES} ON c.case_id = s.task_id),
graded AS (SELECT *, CASE WHEN case_id IS NULL THEN 0.001::DOUBLE
                          WHEN task_id LIKE 'easy%' THEN {grade_easy()}
                          WHEN task_id LIKE 'medium%' THEN {grade_medium()}
                          ELSE {grade_hard()} END AS grade FROM joined)""".replace(" cases(case_id", " c(case_id")
