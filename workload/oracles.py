"""The registered queries in DuckDB's SQL, written independently of the library.

Small helpers build the text rules as SQL expressions; DuckDB literals know no
escapes, so backslashes stand for themselves.
"""

from __future__ import annotations

from workload.registry import (
    DIRECT_ROWS,
    FILE_BYTES,
    FILE_ROWS,
    HEAD_ROWS,
    LIMITED_ROWS,
    SAMPLE_ROWS,
    SEGMENT_CHARS,
    TEST_RATIO,
    TIED_ROWS,
    TOLERANCE,
)

# Fixed values, stated here once more so that a wrong one in the library shows.
INSTRUCTION_SUFFIX = 'Put your final answer inside \\boxed{}.'
SYSTEM_PROMPT = r"""You are generating supervised fine-tuning data for a reasoning model.
Given a puzzle-like prompt, infer the transformation rule from the examples, reason clearly, and end with the final answer inside \boxed{}.
Do not mention that you know the ground-truth answer.
Keep the reasoning concise but useful for training."""
TASK_PREAMBLE = r"""Solve the following reasoning task.
Infer the rule from the examples, explain the reasoning clearly, and end with the final answer inside \boxed{}.

"""
# White space as Python strips it, by code point.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
SPACE_CLASS = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
DIGITS = "[0-9]+(_[0-9]+)*"
NUMBER = rf"^[+-]?({DIGITS}\.?({DIGITS})?|\.{DIGITS})([eE][+-]?{DIGITS})?$"


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE_CLASS}+', ' ', 'g'))"


def latex_space(x: str) -> str:
    return collapse(rf"replace({strip(x)}, '\ ', ' ')")


def latex_strict(x: str) -> str:
    spaced = rf"replace({strip(x)}, '\ ', ' ')"
    return collapse(rf"replace({spaced}, '\', '')")


def last_box(x: str) -> str:
    return rf"regexp_extract_all({x}, '\\boxed\{{([^{{}}]+)\}}', 1)[-1]"


def cut_box(x: str) -> str:
    text = rf"replace({strip(x)}, '\ ', ' ')"
    cut = rf"regexp_replace({text}, '(?s)^(.*)\\boxed\{{.*$', '\1')"
    return strip(
        rf"case when contains({text}, '\boxed{{') then rtrim({cut}, ' .。．') else {text} end"
    )


def number(x: str) -> str:
    bare = strip(f"replace({x}, ',', '')")
    return (
        f"case when regexp_matches({bare}, '{NUMBER}') "
        f"then try_cast(replace({bare}, '_', '') as double) end"
    )


def same(left: str, right: str) -> str:
    return f"coalesce({left} = {right}, false)"


def near(left: str, right: str) -> str:
    a, b = number(collapse(left)), number(collapse(right))
    close = (
        f"abs({a} - {b}) <= greatest(1e-9 * greatest(abs({a}), abs({b})), {TOLERANCE})"
    )
    return f"({same(collapse(left), collapse(right))} or coalesce({close}, false))"


def chat(user: str, assistant: str) -> str:
    return (
        f"concat('<|im_start|>user\n', {user}, '<|im_end|>\n"
        f"<|im_start|>assistant\n', {assistant}, '<|im_end|>')"
    )


def asked(prompt: str) -> str:
    return f"concat({strip(prompt)}, '\n{INSTRUCTION_SUFFIX}')"


def boxed(answer: str) -> str:
    return rf"concat('\boxed{{', {answer}, '}}')"


def reasoned(reasoning: str, answer: str) -> str:
    body = strip(reasoning)
    return (
        rf"case when coalesce({body}, '') = '' then {boxed(strip(answer))} "
        rf"when contains({body}, '\boxed{{') then {body} "
        f"else concat({body}, '\n\nTherefore, the answer is ', {boxed(strip(answer))}) end"
    )


def one_line(x: str, length: int) -> str:
    return f"replace(substr({x}, 1, {length}), '\n', ' ')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- input tables ----------------------------------------------------------

DOCS = r"""docs as (
  select doc_id, concat('d', doc_id) as id, text,
    case doc_id % 4
      when 0 then lpad(bin(n_chars % 256), 8, '0')
      when 1 then concat(n_chars // 100, '.', lpad(cast(n_chars % 100 as varchar), 2, '0'))
      when 2 then concat(lang, ' ', source, ' book')
      else concat(n_chars, ' km') end as answer
  from documents)"""

PROBLEMS = "problems as (select id, text as prompt, answer from docs)"

TRACES = r"""traces as (
  select doc_id, id, text as prompt, answer, case doc_id % 10
      when 0 then concat(text, '

Therefore, the answer is \boxed{', answer, '}.')
      when 1 then concat(text, ' so \boxed{', replace(answer, ' ', '\ '), '}')
      when 2 then concat('First \boxed{wrong} then ', text, ' \boxed{', answer, '}')
      when 3 then concat(text, '\boxed{wrong}')
      when 4 then text
      when 5 then concat(text, ' \boxed{', answer)
      when 6 then concat(text, '。 . \boxed{ ', answer, '  } done')
      when 7 then concat(text, '\boxed{\frac{1}{2}}')
      when 8 then ''
      else concat('\boxed{', answer, '}') end as reasoning
  from docs)"""

COMPLETIONS = """completions as (
  select id, reasoning as completion, 'writer-1' as source_model from traces
  where exists (select 1 from labels where labels.doc_id = traces.doc_id))"""

PREDICTIONS = r"""predictions as (
  select id, answer, case doc_id % 5
      when 0 then concat('  ', replace(answer, ' ', '   '), ' ')
      when 1 then concat(text, ' so \boxed{', answer, '}')
      when 2 then concat('\boxed{0} no, \boxed{', answer, '04}')
      when 3 then concat('\boxed{', answer, '}', text, ' \boxed{wrong}')
      else cast(null as varchar) end as prediction
  from docs)"""

JUDGED = f"""judged as (
  select *, case when prompt = '' or answer = '' or raw_reasoning = '' then 'empty_field'
      when boxed_answer is null or boxed_answer <> answer then 'box_differs'
      when reasoning = '' then 'nothing_left' end as reject_reason
  from (select id, {strip("prompt")} as prompt, {latex_space("answer")} as answer,
      {strip("reasoning")} as raw_reasoning, {cut_box("reasoning")} as reasoning,
      {latex_space(last_box("reasoning"))} as boxed_answer
    from (select id, prompt, coalesce(answer, '') as answer,
        coalesce(reasoning, '') as reasoning from traces)))"""

CLEAN = """clean as (
  select id, prompt, answer, reasoning, boxed_answer from judged where reject_reason is null)"""

POOL = """pool as (
  select * from problems where not exists (select 1 from clean where clean.id = problems.id))"""

PREDICTED = f"coalesce({strip(last_box('prediction'))}, {strip('prediction')})"

SCORED = f"""scored as (
  select id, {strip("answer")} as expected, {PREDICTED} as predicted,
    {strip(last_box("prediction"))} as boxed,
    {same(collapse("answer"), collapse(PREDICTED))} as exact,
    {near("answer", PREDICTED)} as near
  from predictions)"""

PAIRS = f"""pairs as (
  select problems.id as id, prompt, {strip("answer")} as answer, completion as reasoning,
    {strip(last_box("completion"))} as boxed_answer, source_model,
    completions.id is not null as answered
  from problems left join completions on problems.id = completions.id),
verdicts as (
  select *, {same(latex_strict("answer"), latex_strict("boxed_answer"))} as ok from pairs)"""

# Rows of an id that is repeated on both sides meet by their place, the rarer side again and again.
REPEATED = f"""copied_problems as (
  select id, concat('#', unnest(range(case when n % 3 = 0 then n % 4 + 1 else 1 end)), ' ', prompt) as prompt, answer
  from (select *, cast(substr(id, 2) as bigint) as n from problems)),
copied_completions as (
  select id, concat('#', unnest(range(case when n % 3 = 0 then n % 5 + 1 else 1 end)), ' ', completion) as completion,
    source_model
  from (select *, cast(substr(id, 2) as bigint) as n from completions)),
asked as (
  select *, count(*) over (partition by id) as m, row_number() over (partition by id
    order by md5(concat(md5(prompt), ':', md5({strip("answer")})))) - 1 as k from copied_problems),
given as (
  select *, count(*) over (partition by id) as n, row_number() over (partition by id
    order by md5(concat(md5(completion), ':', md5(source_model)))) - 1 as l from copied_completions),
pairs as (
  select asked.id as id, prompt, {strip("answer")} as answer, completion as reasoning,
    {strip(last_box("completion"))} as boxed_answer, given.id is not null as answered
  from asked left join given on asked.id = given.id
    and (m = 1 or n = 1 or k % least(m, n) = l % least(m, n))),
verdicts as (
  select *, {same(latex_strict("answer"), latex_strict("boxed_answer"))} as ok from pairs)"""

DIRECT_TEXT = chat(asked("prompt"), boxed(latex_space("answer")))
TRACE_TEXT = chat(
    rf"concat(prompt, '{chr(10)}{INSTRUCTION_SUFFIX}')",
    rf"concat(reasoning, '{chr(10)}{chr(10)}', {boxed('answer')})",
)

MIX = f"""mix as (
  select 'direct' as origin, id, 0 as copy, {DIRECT_TEXT} as text
  from (select * from pool order by md5(concat('42:', id)), id limit {DIRECT_ROWS})
  union all
  select 'trace', id, copy, {TRACE_TEXT}
  from clean, (select unnest([0, 1]) as copy) as copies)"""

FLAGGED = r"""flagged as (
  select *, contains(text, '<think>') as has_think,
    cast((length(part) - length(replace(part, '\boxed{', ''))) // 7 as integer) as boxes
  from (select *, case when contains(text, '<|im_start|>assistant
') then substr(text, strpos(text, '<|im_start|>assistant
') + 22) else text end as part from mix))"""

REPORT = """report as (
  select (select count(*) from problems) as train_rows,
    (select count(*) from pool) as pool_rows,
    (select count(*) from clean) as clean_rows,
    count(*) filter (where origin = 'direct') as direct_rows,
    count(*) filter (where origin = 'trace') as trace_rows,
    count(*) as mixed_rows,
    count(*) // 4 as optimizer_steps,
    count(*) filter (where origin = 'direct' and boxes = 1) as direct_single_boxed,
    count(*) filter (where origin = 'trace' and boxes = 1) as trace_single_boxed,
    count(*) filter (where origin = 'direct' and has_think) as direct_with_think,
    count(*) filter (where origin = 'trace' and has_think) as trace_with_think
  from flagged)"""


def sql(select: str, *tables: str) -> str:
    return "with " + ",\n".join((DOCS, *tables)) + "\n" + select


def on_problems(select: str) -> str:
    return sql(select, PROBLEMS)


def on_traces(select: str) -> str:
    return sql(select, TRACES)


def on_clean(select: str) -> str:
    return sql(select, TRACES, JUDGED, CLEAN)


def on_pool(select: str) -> str:
    return sql(select, PROBLEMS, TRACES, JUDGED, CLEAN, POOL)


def on_pairs(select: str) -> str:
    return sql(select, PROBLEMS, TRACES, COMPLETIONS, PAIRS)


def on_mix(select: str) -> str:
    return sql(select, PROBLEMS, TRACES, JUDGED, CLEAN, POOL, MIX, FLAGGED, REPORT)


SEEDED = "order by md5(concat('42:', id)), id"
ACCEPTED = "select id, prompt, answer, reasoning, boxed_answer, source_model from verdicts where ok"
REJECTED = f"""select id, answer as expected, boxed_answer as predicted,
    case when not answered then 'no_completion' when boxed_answer is null then 'no_box'
      else 'mismatch' end as reject_reason,
    {one_line("reasoning", 300)} as preview
  from verdicts where not ok"""


def request(token_key: str, model: str, tokens: int, temperature: str) -> str:
    user = f"concat({quoted(TASK_PREAMBLE)}, prompt)"
    system = quoted(SYSTEM_PROMPT)
    return on_problems(f"""select id, '{model}' as model, '{token_key}' as token_key,
    {system} as system_message, {user} as user_message,
    cast(json_object('model', '{model}', '{token_key}', {tokens}, 'messages', [
      {{'role': 'system', 'content': {system}}}, {{'role': 'user', 'content': {user}}}]
      {temperature}) as varchar) as body
  from problems""")


def in_test(kind: str) -> str:
    return on_problems(f"""select id, answer from (
    select id, answer, row_number() over ({SEEDED}) as place, count(*) over () as total
    from problems) where place {kind} ceil(total * {TEST_RATIO})""")


def dataset(kind: str, rows: int = SAMPLE_ROWS) -> str:
    text = chat(asked("prompt"), reasoned("reasoning", "answer"))
    return on_traces(f"""select id, {text} as text from (
    select *, row_number() over ({SEEDED}) as place, count(*) over () as total
    from (select * from traces {SEEDED} limit {rows}))
  where place {kind} ceil(total * {TEST_RATIO})""")


# Every fifth document is there twice more, every seventh has no id.
COPIED = """problems as (
  select case when doc_id % 7 > 0 then id end as id, text as prompt, answer
  from docs, (select unnest([0, 1, 2]) as copy) as copies
  where copy = 0 or doc_id % 5 = 0)"""


def on_copies(select: str) -> str:
    return sql(select, COPIED, TRACES, COMPLETIONS, PAIRS)


def tied(rows: int) -> str:
    """Ties of the seeded key are cut by the MD5 of the row as JSON."""
    content = """concat('{"id":"', id, '","lang":"', lang, '"}')"""
    return f"""select id, lang from (select concat('d', doc_id) as id, lang from documents)
  order by md5(concat('42:', lang)), md5({content}) limit {rows}"""


DIRECT = chat(asked("prompt"), boxed(strip("answer")))
REASONED = chat(asked("prompt"), reasoned("reasoning", "answer"))
SUMMARY = """select count(*) as evaluated, count(*) filter (where {0}) as matched,
    round(count(*) filter (where {0}) / count(*), 4) as accuracy from scored"""

ORACLES: dict[str, str] = {
    "boxed_last": on_traces(
        f"select id, {strip(last_box('reasoning'))} as boxed, "
        f"{latex_space(last_box('reasoning'))} as boxed_normalized from traces"
    ),
    "normalize_profiles": on_traces(
        f"select id, {collapse('box')} as collapse, {latex_space('box')} as latex_space, "
        f"{latex_strict('box')} as latex_strict "
        f"from (select id, {strip(last_box('reasoning'))} as box from traces)"
    ),
    "read_numbers": on_problems(f"select id, {number('answer')} as number from problems"),
    "match_exact": on_traces(
        f"select id, {same(latex_strict('answer'), latex_strict(last_box('reasoning')))} "
        "as matched from traces"
    ),
    "match_tolerance": sql("select id, exact, near from scored", PREDICTIONS, SCORED),
    "prediction_fallback": sql("select id, predicted from scored", PREDICTIONS, SCORED),
    "cut_box": on_traces(f"select id, {cut_box('reasoning')} as reasoning from traces"),
    "text_previews": on_traces(
        "select id, substr(reasoning, 1, 500) as start, "
        f"{one_line('reasoning', 300)} as line from traces"
    ),
    "eval_summary": sql(SUMMARY.format("near"), PREDICTIONS, SCORED),
    "eval_summary_exact": sql(SUMMARY.format("exact"), PREDICTIONS, SCORED),
    "eval_by_group": sql(
        """select concat_ws(',', case when grouping(kind) = 0 then 'kind' end,
      case when grouping(shape) = 0 then 'shape' end) as breakdown, kind, shape, count(*) as evaluated,
    count(*) filter (where near) as matched, round(count(*) filter (where near) / count(*), 4) as accuracy
  from (select near, case when n % 4 > 0 then concat('kind', n % 4) end as kind, concat('shape', n % 5) as shape
    from (select near, cast(substr(id, 2) as bigint) as n from scored))
  group by grouping sets ((), (kind), (shape), (kind, shape))""",
        PREDICTIONS,
        SCORED,
    ),
    "eval_misses": sql(
        "select id, expected, predicted, boxed from scored where not near order by id limit 5",
        PREDICTIONS,
        SCORED,
    ),
    "eval_all_misses": sql(
        "select id, expected, predicted, boxed from scored where not near", PREDICTIONS, SCORED
    ),
    "reasoning_flags": on_traces(
        rf"""select id, contains(text, '\boxed{{') as has_box,
    regexp_matches(text, '\\boxed\{{[^{{}}]+\}}{SPACE_CLASS}*$') as ends_in_box,
    contains(text, '\ ') as has_latex_blank
  from (select id, {strip("reasoning")} as text from traces)"""
    ),
    "clean_traces": on_clean("select * from clean"),
    "clean_rejected": on_clean(
        "select id, answer, boxed_answer, reject_reason from judged "
        "where reject_reason is not null"
    ),
    "clean_report": on_clean(
        rf"""select count(*) as raw_rows,
    count(*) filter (where contains(raw_reasoning, '\boxed{{')) as boxed_any,
    count(*) filter (where regexp_matches(raw_reasoning,
      '\\boxed\{{[^{{}}]+\}}{SPACE_CLASS}*$')) as boxed_at_end,
    count(*) filter (where contains(raw_reasoning, '\ ')) as latex_blank,
    count(*) filter (where reject_reason is null) as clean_rows,
    count(*) filter (where reject_reason is not null) as rejected_rows
  from judged"""
    ),
    "verify_accepted": on_pairs(ACCEPTED),
    "verify_rejected": on_pairs(REJECTED),
    "verify_summary": on_pairs(
        "select count(*) filter (where ok) as accepted_rows, "
        "count(*) filter (where not ok) as rejected_rows from verdicts"
    ),
    "verify_stored": on_pairs(
        "select id, case when ok then 'accepted' when not answered then 'no_completion' "
        "when boxed_answer is null then 'no_box' else 'mismatch' end as outcome from verdicts"
    ),
    "verify_paired": sql(
        f"""select id, md5(prompt) as problem, md5(reasoning) as completion, cast(null as varchar) as reject_reason
  from verdicts where ok union all
  select id, null, md5(preview), reject_reason from ({REJECTED})""",
        PROBLEMS,
        TRACES,
        COMPLETIONS,
        REPEATED,
    ),
    "attached": on_pairs(
        "select id, answer, reasoning as completion, source_model from pairs"
    ),
    "request_rows": request("max_tokens", "gpt-4.1-mini", 1200, ", 'temperature', 0.2"),
    "request_rows_o_series": request("max_completion_tokens", "o4-mini", 16000, ""),
    "request_files": f"""with requests as ({request("max_tokens", "gpt-4.1-mini", 1200, ", 'temperature', 0.2")}),
  lines as (
    select id, body, cast(json_object('id', id, 'body', body) as varchar) as line from requests),
  weighed as (
    select *, greatest((strlen(line) + 1) * {FILE_ROWS}, {FILE_BYTES})::bigint as weight from lines),
  started as (
    select *, coalesce(sum(weight) over (order by md5(line) rows between unbounded preceding and 1 preceding), 0)
      as start from weighed)
  select id, body, (start // ({FILE_ROWS * FILE_BYTES} - (select max(weight) from weighed)))::bigint as file
  from started""",
    "exclude_ids": on_pool("select id, answer from pool"),
    "head_limit": on_problems(f"select id, answer from problems order by id limit {HEAD_ROWS}"),
    "sample_exact": on_problems(
        f"select id, prompt, answer from problems {SEEDED} limit {SAMPLE_ROWS}"
    ),
    "sample_strict": on_problems(
        "select id, answer from problems "
        f"order by md5(concat('7:', id)), id limit {SAMPLE_ROWS}"
    ),
    "sample_pool": on_pool(f"select id, answer from pool {SEEDED} limit {SAMPLE_ROWS}"),
    "shuffle_order": on_problems(
        f"select id, md5(concat('42:', id)) as shuffle_key from problems {SEEDED}"
    ),
    "split_train": in_test(">"),
    "split_test": in_test("<="),
    "oversampled": on_problems(
        "select id, answer, copy from problems, (select unnest([0, 1]) as copy) as copies"
    ),
    "text_direct": on_problems(f"select id, {DIRECT} as text from problems"),
    "text_direct_plain": on_problems(
        f"select id, {chat(strip('prompt'), boxed(strip('answer')))} as text from problems"
    ),
    "text_reasoned": on_traces(f"select id, {REASONED} as text from traces"),
    "text_normalized": on_problems(
        f"select 'direct' as origin, id, 0 as copy, {DIRECT_TEXT} as text from problems"
    ),
    "text_clean_trace": on_clean(
        f"select 'trace' as origin, id, 0 as copy, {TRACE_TEXT} as text from clean"
    ),
    "message_arrays": on_problems(f"select id, {DIRECT} as text, 2 as turns from problems"),
    "chat_turns": f"""select conv_id, turn,
    concat('<|im_start|>', role, '\n', {strip("text")}, '<|im_end|>') as text from conversations""",
    "chat_pairs": f"""select replied.conv_id, replied.turn,
    {chat(strip("asked.text"), strip("replied.text"))} as text
  from conversations as asked join conversations as replied
    on asked.conv_id = replied.conv_id and asked.turn + 1 = replied.turn
  where asked.role = 'user' and replied.role = 'assistant'""",
    "chat_conversations": f"""with rendered as (
    select conv_id, turn, role, {strip("text")} as content,
      concat('<|im_start|>', role, '\n', {strip("text")}, '<|im_end|>') as body from conversations
  ), cut as (
    select *, coalesce(sum(length(body)) over (partition by conv_id
      order by turn nulls first, role nulls first, md5(content) nulls first
      rows between unbounded preceding and 1 preceding), 0)::bigint // {SEGMENT_CHARS} as segment from rendered
  ) select conv_id, segment, count(*)::int as turns,
    string_agg(body, '\n' order by turn nulls first, role nulls first, md5(content) nulls first) as text
  from cut group by conv_id, segment""",
    "baseline_recipe": on_problems(
        f"select id, {DIRECT} as text from problems {SEEDED} limit {SAMPLE_ROWS}"
    ),
    "trace_recipe": on_traces(f"select id, answer, {REASONED} as text from traces"),
    "mixed_recipe": on_mix("select * from mix"),
    "mixed_texts": on_mix("select text from mix"),
    "mix_flags": on_mix("select origin, id, copy, boxes, has_think from flagged"),
    "mix_report": on_mix("select * from report"),
    "mix_checks": on_mix(
        f"""select check_name as "check", violations = 0 as passed, violations from (
    select 'clean_traces_exist' as check_name,
      cast(case when clean_rows > 0 then 0 else 1 end as bigint) as violations from report
    union all select 'direct_one_box', direct_rows - direct_single_boxed from report
    union all select 'trace_one_box', trace_rows - trace_single_boxed from report
    union all select 'direct_no_think', direct_with_think from report
    union all select 'trace_no_think', trace_with_think from report
    union all select 'direct_row_count', abs(direct_rows - least({DIRECT_ROWS}, pool_rows))
      from report)"""
    ),
    "dataset_train": dataset(">"),
    "dataset_test": dataset("<="),
    "load_csv": on_problems("select * from problems"),
    "load_json_lines": on_traces("select id, prompt, answer, reasoning from traces"),
    "load_parquet": "select cast(doc_id as varchar) as doc_id, text, lang, source, "
    "cast(n_chars as varchar) as n_chars from documents",
    "load_predictions_jsonl": sql("select * from predictions", PREDICTIONS),
    "eval_no_id": sql(SUMMARY.format("near"), PREDICTIONS, SCORED),
    "clean_no_id": on_clean("select '' as id, prompt, answer, reasoning, boxed_answer from clean"),
    "baseline_no_id": on_problems(
        f"""select {DIRECT} as text from problems order by md5(concat('42:',
    md5(cast(json_object('prompt', prompt, 'answer', answer) as varchar)))) limit {SAMPLE_ROWS}"""
    ),
    "sample_ties": sql(tied(TIED_ROWS)),
    "sample_ties_more": sql(tied(TIED_ROWS + 1)),
    "verify_copies": on_copies(
        "select id, answer, case when ok then 'accepted' when not answered then 'no_completion' "
        "when boxed_answer is null then 'no_box' else 'mismatch' end as outcome from verdicts"
    ),
    "verify_audit": on_copies(
        """select (select count(*) from (select id from problems where id is not null
      group by id having count(*) > 1)) as repeated_problem_ids,
    (select count(*) from completions
      where not exists (select 1 from problems where problems.id = completions.id))
      as unknown_completions"""
    ),
    "dataset_max_samples": dataset(">", LIMITED_ROWS),
    "dataset_dry_run": dataset(">", 8),
    "append_accepted": sql(
        "select *, cast(null as varchar) as source_model from clean union all " + ACCEPTED,
        PROBLEMS,
        TRACES,
        JUDGED,
        CLEAN,
        COMPLETIONS,
        PAIRS,
    ),
    "append_committed": sql(
        "select *, cast(null as varchar) as source_model from clean union all " + ACCEPTED,
        PROBLEMS,
        TRACES,
        JUDGED,
        CLEAN,
        COMPLETIONS,
        PAIRS,
    ),
    "load_csv_lines": on_problems("select id, answer, concat('\"', answer, '\", ', id) as quoted from problems"),
    "training_sink": on_problems(f"select {DIRECT} as text from problems"),
    "stream_accepted": on_pairs(ACCEPTED),
    "stream_rejected": on_pairs(REJECTED.replace("where not ok", "where answered and not ok")),
}
