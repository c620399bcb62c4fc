"""SQL statements equivalent to ``queries``, for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from bitexture.functions.wrappers import DEFAULT_SYSTEM_PROMPT
from bitexture.suite.fixtures import SQL, sql_hash, with_fixtures
from bitexture.suite.queries import CUT, MAX_TOKENS, ROW_LENGTH, TOP

SPACE = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NL = "chr(10)"


def words(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '\S+'))"


def harmonic(a: str = "bicleaner_ai_score", b: str = "bleualign_score") -> str:
    return f"(2.0::double * {a} * {b} / nullif({a} + {b}, 0))"


FWD = "'RENDER: ENGLISH: ' || src_text || ' FRENCH: ' || trg_text"
BWD = "'RENDER: FRENCH: ' || trg_text || ' ENGLISH: ' || src_text"

PAIRS = with_fixtures("pairs")
CORPUS = with_fixtures("corpus")
LABELLED = with_fixtures("labelled")
EXAMPLES = with_fixtures("examples")
LOG = with_fixtures("run_log")
EXTREMES = with_fixtures("extremes")

BUDGET = f"greatest({words(FWD)}, {words(BWD)}) <= {MAX_TOKENS}"


def curated(size: int) -> str:
    return f"""
      curated as (
        select pair_id, src_text, trg_text, {harmonic()} as hm from pairs where {BUDGET}
        order by hm desc nulls last, pair_id limit {size})"""


def three_way(table: str, id_col: str, seed: int = 7812) -> str:
    return f"""
      ranked as (
        select *, row_number() over (order by {sql_hash(id_col, seed)}, {id_col}) as rn, count(*) over () as total
        from {table}),
      splitted as (
        select * exclude (rn, total),
          case when rn <= floor(total::double * 0.7::double) then 'train'
            when rn <= floor(total::double * 0.7::double) + floor(total::double * 0.15::double) then 'test'
            else 'validation' end as split
        from ranked)"""


def summary(table: str, column: str) -> str:
    x = f"{column}::double"
    return f"""
      select '{column}' as "column", count({column}) as n, round(avg({x}), 6) as mean,
        round(stddev_samp({x}), 6) as std, round(min({x}), 6) as min,
        round(quantile_cont({x}, 0.25), 6) as p25, round(quantile_cont({x}, 0.5), 6) as p50,
        round(quantile_cont({x}, 0.75), 6) as p75, round(max({x}), 6) as max
      from {table} where {column} is not null"""


def histogram(table: str, column: str, bins: int = 30) -> str:
    return f"""
      v as (select {column}::double as x from {table} where {column} is not null),
      e as (select min(x) as low, max(x) as high from v),
      c as (select least(floor((x - low) / (high - low) * {bins}), {bins - 1})::int as bin, count(*) as n
            from v, e group by 1)
      select b::int as bin, round(low + (high - low) / {bins} * b, 6) as low,
        round(low + (high - low) / {bins} * (b + 1), 6) as high, coalesce(n, 0) as n
      from range({bins}) g(b) cross join e left join c on c.bin = b"""


LENGTHS = f"""
      lengths as (
        select pair_id, ({words(FWD)} + {words(BWD)}) / 2.0::double as prompt_length,
          {words('src_text')} + {words('trg_text')} as raw_length
        from pairs)"""


def wrap(train: str, query: str) -> str:
    return f"{PAIRS} select pair_id, {train} as train_text, {query} as query_text from pairs"


def lines(text: str) -> str:
    """SQL string literal for a Python string with line breaks."""
    parts = [f"'{p.replace(chr(39), chr(39) * 2)}'" for p in text.split("\n")]
    return " || chr(10) || ".join(parts)


def templated(prefix: str, source: str, middle: str, target: str, suffix: str = "") -> str:
    parts = [lines(prefix), source, lines(middle), target]
    return " || ".join([*parts, lines(suffix)] if suffix else parts)


# The packaged catalogue once more, as (prefix, middle) per start language.
PLAIN_EN = {
    "en": [
        ("Put this English passage into French.\nEnglish:\n", "\n\nFrench:\n"),
        ("French version, please.\nEnglish:\n", "\n\nFrench:\n"),
        ("EN to FR\n", "\n\n"),
    ],
    "fr": [
        ("Put this French passage into English.\nFrench:\n", "\n\nEnglish:\n"),
        ("English version, please.\nFrench:\n", "\n\nEnglish:\n"),
        ("FR to EN\n", "\n\n"),
    ],
}
PLAIN_FR = {
    "en": [
        ("Mets ce passage anglais en français.\nAnglais:\n", "\n\nFrançais:\n"),
        ("Version française, merci.\nAnglais:\n", "\n\nFrançais:\n"),
    ],
    "fr": [
        ("Mets ce passage français en anglais.\nFrançais:\n", "\n\nAnglais:\n"),
        ("Version anglaise, merci.\nFrançais:\n", "\n\nAnglais:\n"),
    ],
}
GRID_FR = {
    "en": [("anglais -> français.\n", "\n\n"), ("français voulu.\n", "\n")],
    "fr": [("français -> anglais.\n", "\n\n"), ("anglais voulu.\n", "\n")],
}
GRID_EN = {
    "en": [("From English to French.\n", "\n\n"), ("French wanted.\n", "\n")],
    "fr": [("From French to English.\n", "\n\n"), ("English wanted.\n", "\n")],
}


def choose(wordings: list[tuple[str, str]], index: str, source: str, target: str) -> str:
    whens = " ".join(
        f"when {i} then {templated(prefix, source, middle, target)}" for i, (prefix, middle) in enumerate(wordings)
    )
    return f"case {index} {whens} end"


def expanded(wordings: dict[str, list[tuple[str, str]]], index: str, i: str = "i") -> str:
    """Both directions; ``index`` turns a call number placeholder {c} and a count {n} into a template index."""
    fwd = choose(wordings["en"], index.format(c=f"(2 * {i})", n=len(wordings["en"])), "src_text", "trg_text")
    bwd = choose(wordings["fr"], index.format(c=f"(2 * {i} + 1)", n=len(wordings["fr"])), "trg_text", "src_text")
    return f"""{PAIRS}, numbered as (select *, row_number() over (order by pair_id) - 1 as i from pairs)
      select pair_id, 'fwd' as direction, {fwd} as text from numbered
      union all select pair_id, 'bwd' as direction, {bwd} as text from numbered"""


ROUND_ROBIN = "({c} % {n})"
RANDOM = "(" + sql_hash("{c}", 123) + " % {n})"

TURN_WORDINGS = [
    ("<start_of_turn>user\nFrench for this, please:\n", "<end_of_turn>\n<start_of_turn>model\n"),
    ("<start_of_turn>user\nWrite it in French:\n", "<end_of_turn>\n<start_of_turn>model\n"),
]

CODEPOINTS = f"list_transform(string_split(substr(text, 1, {ROW_LENGTH}), ''), lambda c: unicode(c)::int)"
IDS = f"case when text = '' then []::int[] else {CODEPOINTS} end"
PADDED = f"list_resize({IDS}, {ROW_LENGTH}, 0)"
MASK = (
    f"list_transform(range({ROW_LENGTH}), lambda i: (case when i < least(length(text), {ROW_LENGTH}) "
    "then 1 else 0 end)::int)"
)


def grams(orders: int, source: str = "examples", unit: str = "char", keys: str = "dataset") -> str:
    """CTEs ``units`` (one row per example and side) and ``counts`` (h and r per example, order and gram)."""
    if unit == "char":
        body, n_units, gram = "t", "length(t)", "substr(t, i, n)"
    else:
        body, n_units, gram = "u", r"len(regexp_extract_all(t, '\S+'))", "array_to_string(u[i:i + n - 1], ' ')"
    cut = "" if unit == "char" else r"regexp_extract_all(t, '\S+') as u, "
    return f"""
      sides as (
        select {keys}, example_id, 1 as h, 0 as r, predictions as t from {source}
        union all select {keys}, example_id, 0 as h, 1 as r, outputs as t from {source}),
      units as (select *, {cut}{n_units} as n_units from sides),
      occurrences as (
        select {keys}, example_id, h, r, {body}, n, unnest(range(1, n_units - n + 2)) as i
        from units cross join range(1, {orders + 1}) q(n)),
      counts as (
        select {keys}, example_id, n, {gram} as gram, sum(h)::bigint as h, sum(r)::bigint as r
        from occurrences group by all),
      lens as (
        select {keys}, example_id, max(case when h = 1 then n_units end) as hl,
          max(case when r = 1 then n_units end) as rl
        from units group by all)"""


def bleu(source: str = "examples", unit: str = "char", keys: str = "dataset") -> str:
    return f"""{grams(4, source, unit, keys)},
      m as (select {keys}, n, sum(least(h, r))::bigint as m from counts group by all),
      t as (select {keys}, n, sum(greatest(hl - n + 1, 1))::bigint as t
            from lens cross join range(1, 5) q(n) group by all),
      l as (select {keys}, sum(hl)::bigint as hyp, sum(rl)::bigint as ref from lens group by all),
      logs as (
        select {keys}, sum(ln(case when coalesce(m, 0) > 0 then m::double / t else 2.2250738585072014e-308 end)) / 4 as s,
          max(case when n = 1 then coalesce(m, 0) end) as m1
        from t left join m using ({keys}, n) group by all),
      bleu as (
        select {keys}, 'bleu' as metric,
          round(case when m1 = 0 then 0 else
            (case when hyp > ref then 1 when hyp = 0 then 0 else exp(1 - ref::double / hyp) end) * exp(s) end, 6)
            as score
        from logs join l using ({keys}))"""


def gleu(keys: str = "dataset") -> str:
    """Continues after ``bleu``."""
    def n_grams(length: str) -> str:
        return " + ".join(f"greatest({length} - {n - 1}, 0)" for n in range(1, 5))

    return f"""
      gleu as (
        select {keys}, 'gleu' as metric, round(coalesce(mm::double / nullif(total, 0), 0), 6) as score
        from (select {keys}, sum(greatest({n_grams('hl')}, {n_grams('rl')}))::bigint as total from lens group by all)
        left join (select {keys}, sum(m)::bigint as mm from m group by all) using ({keys}))"""


def chrf(keys: str = "dataset") -> str:
    return f"""packed as (
        select {keys}, example_id, regexp_replace(predictions, '{SPACE}+', '', 'g') as predictions,
          regexp_replace(outputs, '{SPACE}+', '', 'g') as outputs from examples),
      {grams(6, 'packed', 'char', keys)},
      m6 as (select {keys}, example_id, n, sum(least(h, r))::bigint as m from counts group by all),
      parts as (
        select {keys}, coalesce(m, 0)::double / nullif(greatest(hl - n + 1, 0), 0) as p,
          coalesce(m, 0)::double / nullif(greatest(rl - n + 1, 0), 0) as rc
        from lens cross join range(1, 7) q(n) left join m6 using ({keys}, example_id, n)),
      chrf as (
        select {keys}, 'chrf' as metric,
          round(avg(coalesce(10::double * (p * rc) / nullif(9::double * p + rc, 0), 1e-16::double)), 6) as score
        from parts group by {keys})"""


def nist(keys: str = "dataset") -> str:
    return f"""{grams(5, 'examples', 'char', keys)},
      g as (select {keys}, n, gram, sum(r)::bigint as r, sum(least(h, r))::bigint as matched from counts group by all),
      l as (select {keys}, sum(hl)::bigint as hyp, sum(rl)::bigint as ref from lens group by all),
      t as (select {keys}, n, sum(greatest(hl - n + 1, 0))::bigint as t
            from lens cross join range(1, 6) q(n) group by all),
      info as (
        select a.{keys}, a.n, sum(a.matched * log2(coalesce(b.r, l.ref)::double / a.r)) as gain
        from g a left join g b on a.{keys} = b.{keys} and b.n = a.n - 1 and b.gram = substr(a.gram, 1, a.n - 1)
          and b.r > 0
        join l on l.{keys} = a.{keys} where a.r > 0 group by all),
      prec as (
        select {keys}, sum(coalesce(coalesce(gain, 0) / nullif(t, 0), 0)) as p
        from t left join info using ({keys}, n) group by all),
      nist as (
        select {keys}, 'nist' as metric,
          round(p * case when hyp > 0 and hyp < ref
            then exp(ln(0.5::double) / pow(ln(1.5::double), 2) * pow(ln(hyp::double / ref), 2))
            else greatest(least(hyp::double / ref, 1), 0) end, 6) as score
        from prec join l using ({keys}))"""


def _referenced(orders: int, name: str, text: Callable[[str], str]) -> str:
    """CTEs ``<name>hc`` and ``<name>rc`` (grams of hypotheses and of each reference) and ``<name>len`` (lengths per reference)."""
    return f"""
      {name}sides as (
        select dataset, example_id, -1 as j, predictions as raw, {text('predictions')} as t from with_references
        union all
        select dataset, example_id, j, raw, {text('raw')} as t
        from (select dataset, example_id, unnest(outputs) as raw, generate_subscripts(outputs, 1) - 1 as j from with_references)),
      {name}occ as (
        select dataset, example_id, j, n, substr(t, i, n) as gram, count(*) as c
        from (select *, unnest(range(1, length(t) - n + 2)) as i from {name}sides cross join range(1, {orders + 1}) q(n))
        group by all),
      {name}hc as (select dataset, example_id, n, gram, c as h from {name}occ where j < 0),
      {name}rc as (select dataset, example_id, j, n, gram, c as r from {name}occ where j >= 0),
      {name}len as (
        select r.dataset, r.example_id, r.j, length(h.t) as hl, length(r.t) as rl
        from {name}sides h join {name}sides r on h.dataset is not distinct from r.dataset and h.example_id = r.example_id
        where h.j < 0 and r.j >= 0)"""


def _gram_sum(length: str) -> str:
    return " + ".join(f"greatest({length} - {n - 1}, 0)" for n in range(1, 5))


def references() -> str:
    """Every metric over lists of references, from the grams of each reference on its own."""
    both = "join rc using (dataset, example_id, n, gram)"
    return f"""{with_fixtures('with_references')}, {_referenced(5, '', lambda t: t)},
      {_referenced(6, 'p', lambda t: f"regexp_replace({t}, '{SPACE}+', '', 'g')")},
      most as (select dataset, example_id, n, gram, max(r) as r from rc group by all),
      m as (select dataset, n, sum(least(h, r))::bigint as m from hc join most using (dataset, example_id, n, gram) group by all),
      near as (
        select dataset, example_id, any_value(hl) as hl, min(struct_pack(d := abs(rl - hl), l := rl)).l as rl from len group by all),
      t as (select dataset, n, sum(greatest(hl - n + 1, 1))::bigint as t, sum(greatest(hl - n + 1, 0))::bigint as t0
            from near cross join range(1, 6) q(n) group by all),
      logs as (
        select dataset, sum(ln(case when coalesce(m, 0) > 0 then m::double / t else 2.2250738585072014e-308 end)) / 4 as s,
          max(case when n = 1 then coalesce(m, 0) end) as m1
        from t left join m using (dataset, n) where n <= 4 group by all),
      bleu as (
        select dataset, 'bleu' as metric,
          case when m1 = 0 then 0 else (case when hyp > ref then 1 when hyp = 0 then 0 else exp(1 - ref::double / hyp) end) * exp(s) end as score
        from logs join (select dataset, sum(hl)::bigint as hyp, sum(rl)::bigint as ref from near group by all) using (dataset)),
      overlap as (select dataset, example_id, j, sum(least(h, r))::bigint as tp from hc {both} where n <= 4 group by all),
      shares as (
        select dataset, example_id, j, coalesce(tp, 0) as tp, greatest({_gram_sum('hl')}, {_gram_sum('rl')}) as g
        from len left join overlap using (dataset, example_id, j)),
      gleu as (
        select dataset, 'gleu' as metric, coalesce(sum(b.tp)::double / nullif(sum(b.g), 0), 0) as score
        from (select dataset, example_id, max(struct_pack(s := tp::double / g, f := -j, tp := tp, g := g)) as b
              from shares where g > 0 group by all)
        group by all),
      pm as (
        select dataset, example_id, j, n, sum(least(h, r))::bigint as m
        from phc join prc using (dataset, example_id, n, gram) group by all),
      parts as (
        select dataset, example_id, j, coalesce(m, 0)::double / nullif(greatest(hl - n + 1, 0), 0) as p,
          coalesce(m, 0)::double / nullif(greatest(rl - n + 1, 0), 0) as rc
        from plen cross join range(1, 7) q(n) left join pm using (dataset, example_id, j, n)),
      chrf as (
        select dataset, 'chrf' as metric, avg(f) / 6 as score
        from (select dataset, example_id, max(f) as f
              from (select dataset, example_id, j, sum(coalesce(10::double * (p * rc) / nullif(9::double * p + rc, 0), 1e-16::double)) as f
                    from parts group by all)
              group by all)
        group by all),
      seen as (select dataset, n, gram, sum(r)::bigint as r from rc group by all),
      total as (select dataset, sum(rl)::bigint as ref_len from len group by all),
      info as (
        select a.dataset, a.n, a.gram, log2(coalesce(b.r, ref_len)::double / a.r) as info
        from seen a left join seen b on a.dataset = b.dataset and b.n = a.n - 1 and b.gram = substr(a.gram, 1, a.n - 1)
        join total on total.dataset = a.dataset),
      gains as (
        select dataset, example_id, j, n, sum(info * least(h, r)) as gain
        from hc {both} join info using (dataset, n, gram) group by all),
      picked as (
        select dataset, example_id, n, any_value(hl) as hl, max(struct_pack(s := round(coalesce(gain, 0), 6), l := rl, g := coalesce(gain, 0))) as b
        from len cross join range(1, 6) q(n) left join gains using (dataset, example_id, j, n) group by all),
      per_order as (
        select dataset, n, sum(b.g) as g, sum(b.l)::bigint as rl, sum(hl)::bigint as hl from picked group by all),
      nist as (
        select dataset, 'nist' as metric, p * case when hyp > 0 and hyp < ref
            then exp(ln(0.5::double) / pow(ln(1.5::double), 2) * pow(ln(hyp::double / ref), 2))
            else greatest(least(hyp::double / ref, 1), 0) end as score
        from (select dataset, sum(coalesce(g / nullif(t0, 0), 0)) as p, sum(rl)::bigint as ref, sum(hl)::bigint as hyp
              from per_order join t using (dataset, n) group by all))
      select dataset, metric, round(score, 6) as score
      from (select * from bleu union all select * from gleu union all select * from chrf union all select * from nist)"""


GUARDED = """
      counted as (
        select *, sum(case when isnan(loss) then 1 else 0 end) over (
          partition by run_id order by step rows unbounded preceding) as nan_before from run_log),
      guarded as (
        select * exclude (nan_before), nan_before::bigint as nan_before from counted
        where not isnan(loss) and nan_before < 3)"""

BATCH = 8

PERPLEXITY = f"""with {SQL['tokens']},
            shifted as (select logits, lead(label) over (partition by seq_id order by pos) as label from tokens),
            nll as (
              select ln(list_sum(list_transform(logits, lambda x: exp(x::double - list_max(logits)::double))))
                + list_max(logits)::double - logits[label + 1]::double as nll
              from shifted where label is not null and label <> -100)
            select count(*) as n_tokens, round(exp(avg(nll)), 6) as perplexity from nll"""

EVALUATION = f"""{PAIRS}, {three_way('pairs', 'pair_id')}"""
PROMPT = "'RENDER: ENGLISH: ' || src_text || ' FRENCH: '"


def all_oracles() -> dict[str, str]:
    report = []
    for name, body in (
        ("bleu", bleu()),
        ("gleu", bleu() + "," + gleu()),
        ("chrf", chrf()),
        ("nist", nist()),
    ):
        report.append(
            f"select * from ({EXAMPLES}, {body} select 'suite' as experiment, 'r1' as run_id, dataset, metric, score"
            f" from {name})"
        )
    return {
        "curate_topk": f"{PAIRS}, {curated(TOP)} select pair_id, src_text, trg_text, round(hm, 6) as sort_score from curated",
        "curate_large": f"{PAIRS}, {curated(100_000)} select pair_id, round(hm, 6) as sort_score from curated",
        "curate_cut": f"""{PAIRS}, fitting as (
              select pair_id from ({expanded(PLAIN_EN, ROUND_ROBIN)}) group by 1 having max(strlen(text)) <= 1200)
            select pair_id, round(hm, 6) as sort_score from (
              select pair_id, {harmonic()} as hm from pairs join fitting using (pair_id))
            order by hm desc nulls last, pair_id limit {CUT}""",
        "token_budget": f"""{PAIRS} select pair_id, src_text, trg_text from pairs
            where greatest(strlen({FWD}), strlen({BWD})) <= 1200""",
        "token_budget_plugin": f"""{PAIRS} select pair_id, src_text, trg_text from pairs
            where greatest(strlen({FWD}), strlen({BWD})) <= 1200""",
        "top_by_score": f"""{PAIRS} select pair_id, bleualign_score from pairs
            order by bleualign_score desc nulls last, pair_id limit {TOP}""",
        "top_score_floor": f"""{PAIRS} select min(s) as lowest_score from (select bicleaner_ai_score as s from pairs
            order by bicleaner_ai_score desc nulls last, pair_id limit {TOP})""",
        "clean_pairs": f"""{with_fixtures('pairs', 'noisy_pairs')}
            select min(pair_id) as pair_id, src_text, trg_text as reference from noisy_pairs
            where src_text is not null and trg_text is not null group by src_text, trg_text""",
        "harmonic_scores": f"{PAIRS} select pair_id, round({harmonic()}, 6) as sort_score from pairs",
        "score_summary": f"""{PAIRS} {summary('pairs', 'bicleaner_ai_score')}
            union all {summary('pairs', 'bleualign_score')}""",
        "score_histogram": f"{PAIRS}, {histogram('pairs', 'bicleaner_ai_score')}",
        "score_density": f"""{PAIRS},
            v as (select bicleaner_ai_score as x from pairs where bicleaner_ai_score is not null),
            e as (select min(x) as low, max(x) as high, stddev_samp(x) * pow(count(*)::double, -0.2::double) as w
                  from v),
            g as (select p, low + (high - low) / 199 * p as spot, w, low, high from range(200) q(p), e)
            select p::int as point, round(spot, 6) as x,
              round(sum(exp(-0.5::double * pow((spot - v.x) / w, 2))) / sqrt(2 * pi()) / w * (high - low) / 30, 4)
                as density
            from v, g group by p, spot, w, low, high""",
        "extreme_quartiles": f"""{EXTREMES}
            select count(*) as n, min(x) as min, round(quantile_cont(x, 0.25), 6) as p25, round(quantile_cont(x, 0.5), 6) as p50,
              round(quantile_cont(x, 0.75), 6) as p75, max(x) as max
            from extremes where not isnan(x)""",
        "extreme_histogram": f"""{EXTREMES},
            f as (select x from extremes where isfinite(x)),
            {histogram('f', 'x')}
            union all
            select case when x > 0 then 30 else -1 end as bin, x as low, x as high, count(*) as n
            from extremes where isinf(x) group by all""",
        "length_analysis": f"""{PAIRS}, {LENGTHS} {summary('lengths', 'prompt_length')}
            union all {summary('lengths', 'raw_length')}""",
        "length_histogram": f"{PAIRS}, {LENGTHS}, {histogram('lengths', 'raw_length')}",
        "token_counters": f"""{CORPUS} select doc_id, {words('text')}::int as n_ws, length(text)::int as n_chars,
            strlen(text)::int as n_bytes from corpus""",
        "seeded_shuffle": f"""{CORPUS} select row_number() over (order by {sql_hash('doc_id', 1337)}, doc_id) - 1
            as position, doc_id, text from corpus""",
        "seeded_subsample": f"{CORPUS} select * from corpus order by {sql_hash('doc_id', 5439)}, doc_id limit 150",
        "sample_preview": f"{CORPUS} select doc_id, text from corpus order by {sql_hash('doc_id', 9123)}, doc_id limit 10",
        "split_three_way": f"""{PAIRS}, {three_way('pairs', 'pair_id')}
            select pair_id, src_text, trg_text, split from splitted""",
        "split_two_way": f"""{CORPUS}, r as (select *, count(*) over () as total,
              row_number() over (order by {sql_hash('doc_id', 42)}, doc_id) as rn from corpus)
            select doc_id, source, case when rn <= ceil(total::double * 0.1::double) then 'test' else 'train' end
              as split from r""",
        "split_counts": f"""{CORPUS}, {three_way('corpus', 'doc_id')}
            select coalesce(split, 'all') as split, count(*) as n from splitted group by rollup (split)""",
        "stratified_resplit": f"""{LABELLED}, r as (
              select doc_id, label, count(*) over (partition by label) as total,
                row_number() over (partition by label order by {sql_hash('doc_id', 42)}, doc_id) as rn
              from labelled)
            select doc_id, coalesce(label::varchar, 'none') as label, case when total < 2 or rn <= floor(total::double * 0.7::double) then 'train'
              when rn <= floor(total::double * 0.7::double) + floor(total::double * 0.15::double) then 'test'
              else 'validation' end as split from r""",
        "class_distribution": f"""{LABELLED} select split, label, n, round(n::double / sum(n) over (partition by split), 6)
              as share
            from (select split, label, count(*) as n from labelled where label is not null group by all)""",
        "limit_examples": f"{CORPUS} select * from corpus order by doc_id limit 100",
        "concat_splits": f"{LABELLED} select * replace (coalesce(label, -1) as label) from labelled",
        "prompts_fixed_train": f"{PAIRS} select pair_id, {FWD} as prompt_fwd, {BWD} as prompt_bwd from pairs",
        "prompts_fixed_query": f"""{PAIRS} select pair_id, case when pair_id % 2 = 0 then 'en' else 'fr' end as start_lang,
            case when pair_id % 2 = 0 then 'RENDER: ENGLISH: ' || src_text || ' FRENCH: '
              else 'RENDER: FRENCH: ' || src_text || ' ENGLISH: ' end as prompt from pairs""",
        "prompts_round_robin": expanded(PLAIN_EN, ROUND_ROBIN),
        "prompts_random": expanded(PLAIN_EN, RANDOM, "pair_id"),
        "prompts_lookup": f"""{PAIRS}, numbered as (select *, row_number() over (order by pair_id) - 1 as i from pairs)
            select pair_id, case when pair_id % 2 = 0 then 'en' else 'fr' end as start_lang,
              (i % 2)::int as template_idx,
              case when pair_id % 2 = 0 then {choose(PLAIN_FR['en'], 'i % 2', 'src_text', 'trg_text')}
                else {choose(PLAIN_FR['fr'], 'i % 2', 'src_text', 'trg_text')} end as prompt
            from numbered""",
        "prompts_turn_query": f"""{PAIRS} select pair_id,
            {choose(TURN_WORDINGS, 'pair_id % 2', 'src_text', "''")} as prompt from pairs""",
        "wrap_identity": wrap("src_text", "src_text"),
        "wrap_bracket": wrap(
            "'<s>[INST] ' || src_text || ' [/INST]' || trg_text || '</s>'", "'[INST] ' || src_text || ' [/INST]'"
        ),
        "wrap_system": wrap(
            f"{lines('<s>[INST] <<SYS>>' + chr(10) + 'You translate.' + chr(10) + '<</SYS>>' + chr(10) * 2)}"
            " || src_text || ' [/INST]' || trg_text || '</s>'",
            f"{lines('<s>[INST] <<SYS>>' + chr(10) + 'You translate.' + chr(10) + '<</SYS>>' + chr(10) * 2)}"
            " || src_text || ' [/INST]'",
        ),
        "wrap_turns": wrap(
            templated("<start_of_turn>user\n", "src_text", "<end_of_turn>\n<start_of_turn>model\n", "trg_text", "<end_of_turn>"),
            templated("<start_of_turn>user\n", "src_text", "<end_of_turn>\n<start_of_turn>model\n", "''"),
        ),
        "template_grid_prompts": f"""select *, 'fr' as written_in from ({expanded(GRID_FR, ROUND_ROBIN)})
            union all select *, 'en' as written_in from ({expanded(GRID_EN, ROUND_ROBIN)})""",
        "bidirectional_expand": f"""{PAIRS} select pair_id, 'fwd' as direction, {FWD} as text from pairs
            union all select pair_id, 'bwd' as direction, {BWD} as text from pairs""",
        "training_texts": f"""{PAIRS}, {three_way('pairs', 'pair_id')}
            select pair_id, split, 'fwd' as direction, {FWD} as text from splitted where split <> 'test'
            union all select pair_id, split, 'bwd' as direction, {BWD} as text from splitted where split <> 'test'""",
        "strip_text": f"""{CORPUS} select doc_id,
            regexp_replace(' ' || chr(9) || ' ' || text || '  ' || chr(10), '^{SPACE}+|{SPACE}+$', '', 'g') as text
            from corpus""",
        "source_union": rf"""{CORPUS} select source, regexp_replace(line, '{SPACE}+$', '') as text, count(*) as n,
              true as keys_distinct
            from (select source, unnest(string_split_regex(text, '\r\n|\r|\n')) as line from corpus) group by 1, 2""",
        "text_lines": rf"""{CORPUS} select line as text, count(*) as n
            from (select unnest(string_split_regex(text, '\r\n|\r|\n')) as line from corpus) group by 1""",
        "tsv_roundtrip": rf"""{PAIRS} select 'http://x/' || pair_id as src_url, 1::bigint as rows_with_id,
              '"NA" ' || regexp_replace(src_text, '[\r\n\t]', ' ', 'g') as src_text,
              '"NA" ' || regexp_replace(trg_text, '[\r\n\t]', ' ', 'g') as trg_text,
              bicleaner_ai_score, bleualign_score from pairs""",
        "dataset_registry": """select 'label' as origin, doc_id, text from documents where lang = 'en'
            union all select 'path' as origin, doc_id, text from documents""",
        "build_if_missing": f"""{PAIRS}, {three_way('pairs', 'pair_id')}
            select pair_id, src_text, trg_text, split from splitted where split = 'validation'""",
        "curation_job": f"""{PAIRS}, {curated(TOP)}, {three_way('curated', 'pair_id')}
            select split, src_text as text from splitted where split = 'test'
            union all select split, {FWD} as text from splitted where split <> 'test'
            union all select split, {BWD} as text from splitted where split <> 'test'""",
        "tokenize_fixed": f"""{CORPUS} select doc_id, {PADDED} as input_ids, {MASK} as attention_mask,
            {PADDED} as labels from corpus""",
        "loss_label_rows": f"""{CORPUS} select doc_id,
            list_transform({PADDED}, lambda x: (case when x = 0 then -100 else x end)::int) as labels from corpus""",
        "real_lengths": f"""{CORPUS} select doc_id,
            coalesce(nullif(list_position({PADDED}, 46), 0) - 1, {ROW_LENGTH})::int as real_length from corpus""",
        "tokenize_plugin": f"""{CORPUS} select doc_id, strlen(text)::int as n_tokens, {ROW_LENGTH} as row_length,
            least(strlen(text), {ROW_LENGTH})::int as n_real from corpus""",
        "token_cache": f"""{CORPUS} select {PADDED} as input_ids, {MASK} as attention_mask,
              list_transform({PADDED}, lambda x: (case when x = 0 then -100 else x end)::int) as labels, count(*) as n
            from corpus group by 1, 2, 3""",
        "length_grouped_batches": f"""with r as (
              select doc_id as id, length(text) as length,
                row_number() over (order by {sql_hash('doc_id', 42)}, doc_id) - 1 as position, count(*) over () as total
              from documents),
            s as (select *, greatest(least(total // ({BATCH} * 4), 50), 1) * {BATCH} as mega_size from r),
            o as (select *, position // mega_size as mega from s),
            p as (select *, mega * mega_size + row_number() over (partition by mega order by length desc, position) - 1
                    as place from o),
            best as (select place as top from p where place % mega_size = 0 order by length desc, place limit 1),
            swapped as (select id, length, case when place = top then 0 when place = 0 then top else place end as place
                        from p, best)
            select id, length, place // {BATCH} as batch, (place % {BATCH})::int as slot from swapped""",
        "eval_inputs": f"""{EVALUATION} select pair_id as example_id,
            {lines('<s>[INST] <<SYS>>' + chr(10) + DEFAULT_SYSTEM_PROMPT + chr(10) + '<</SYS>>' + chr(10) * 2)}
              || {PROMPT} || ' [/INST]' as inputs,
            trg_text as outputs, 'pairs' as dataset from splitted where split = 'test'""",
        "prompt_preview": f"""{EVALUATION} select 'pairs' as dataset, pair_id as example_id, {PROMPT} as prompt,
            trg_text as expected from splitted where split = 'test' order by pair_id limit 10""",
        "batch_generate": f"""{PAIRS} select pair_id as example_id, {PROMPT} as inputs,
            {PROMPT} || array_to_string(list_reverse(string_split({PROMPT}, ' ')), ' ') as generated from pairs""",
        "cut_prefix": f"{PAIRS} select pair_id as example_id, trg_text as predictions from pairs",
        "predictions_roundtrip": f"""{EXAMPLES} select experiment, '2024-01-01-00-00-00' as run_id, dataset, example_id,
            case when inputs = '' then 'nan' else inputs end as inputs,
            case when outputs = '' then 'nan' else outputs end as outputs,
            case when predictions = '' then 'nan' else predictions end as predictions
            from examples where example_id % 3 <> 0""",
        "evaluation_job": f"""{EVALUATION},
            shown as (select *, {PROMPT} as prompt from splitted where split = 'test' order by pair_id limit 50),
            answers as (select 'pairs' as dataset, pair_id as example_id, trg_text as outputs,
              array_to_string(list_reverse(string_split(prompt, ' ')), ' ') as predictions from shown),
            {bleu('answers')}, {gleu()}
            select 'suite' as experiment, 'r1' as run_id, dataset, metric, score from bleu
            union all select 'suite' as experiment, 'r1' as run_id, dataset, metric, score from gleu""",
        "metric_bleu": f"{EXAMPLES}, {bleu()} select dataset, metric, score from bleu",
        "metric_bleu_words": f"{EXAMPLES}, {bleu(unit='word')} select dataset, metric, score from bleu",
        "metric_gleu": f"{EXAMPLES}, {bleu()}, {gleu()} select dataset, metric, score from gleu",
        "metric_chrf": f"{EXAMPLES}, {chrf()} select dataset, metric, score from chrf",
        "metric_nist": f"{EXAMPLES}, {nist()} select dataset, metric, score from nist",
        "metric_references": references(),
        "metric_report": " union all ".join(report),
        "perplexity_score": PERPLEXITY,
        "perplexity_sequences": PERPLEXITY,
        "nan_guard": f"{LOG}, {GUARDED} select run_id, step, loss, nan_before from guarded",
        "smoothed_loss": f"""{LOG}, {GUARDED}
            select run_id, step, count(*) over w as n_smoothed,
              (sum(cast(round(loss * 100) as bigint)) over w)::bigint as window_cents
            from guarded window w as (partition by run_id order by step rows between 99 preceding and current row)""",
        "accumulation_groups": f"""{LOG}, {GUARDED},
            f as (select *, case when (step_in_epoch + 1) % 8 = 0 then 1 else 0 end as fires from guarded),
            g as (select *, (sum(fires) over (partition by run_id order by step rows unbounded preceding) - fires)::bigint
                  as optimizer_step from f)
            select run_id, optimizer_step, min(step) as first_step, max(step) as last_step, count(*) as n_micro,
              round(sum(loss), 4) as loss_sum from g group by run_id, optimizer_step having max(fires) = 1""",
        "stream_prompts": f"""{PAIRS}, fit as (select * from pairs where {BUDGET})
            select pair_id, 'fwd' as direction, {FWD} as text from fit
            union all select pair_id, 'bwd' as direction, {BWD} as text from fit""",
        "stream_runs": f"""{LOG}, {GUARDED}
            select run_id, step, nan_before::integer as nan_before, (count(*) over w)::integer as n_smoothed,
              (sum(cast(round(loss * 100) as bigint)) over w)::bigint as window_cents
            from guarded window w as (partition by run_id order by step rows between 99 preceding and current row)""",
        "stream_monitor": f"""{LOG} select date_trunc('hour', ts) as window_start, event_type,
              count_if(not isnan(loss))::bigint as n_valid, count_if(isnan(loss))::bigint as n_nan,
              round(sum(case when isnan(loss) then null else loss end), 4) as loss_sum
            from run_log group by 1, 2""",
    }
