"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tracemill as tm
from tracemill.functions import answers, chat
from tracemill.functions.text import preview, strip_long
from tracemill.operators import checks, evaluation
from tracemill.operators.cleaning import trace_flags
from tracemill.operators.combine import attach_completions, oversample
from tracemill.operators.conversations import conversation_texts
from tracemill.operators.ranking import seeded_key
from tracemill.operators.verification import Fields
from tracemill.plans import recipes
from tracemill.sources import sinks
from tracemill.sources.records import ACCEPTED_FIELDS
from tracemill.sources.staging import stage, staging_path
from tracemill.streaming import arrivals
from workload.derived import completions, predictions, problems, table, traces

Query = Callable[[SparkSession, str], DataFrame]

TOLERANCE = 0.001
SAMPLE_ROWS = 100
HEAD_ROWS = 50
TEST_RATIO = 0.1
DIRECT_ROWS = 500
TIED_ROWS = 20
LIMITED_ROWS = 30
SEGMENT_CHARS = 2000
FILE_ROWS = 30
FILE_BYTES = 100_000

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- answers ---------------------------------------------------------------


@query
def boxed_last(spark, sf):
    text = F.col("reasoning")
    return traces(spark, sf).select(
        "id",
        answers.last_boxed(text).alias("boxed"),
        answers.last_boxed(text, "latex_space").alias("boxed_normalized"),
    )


@query
def normalize_profiles(spark, sf):
    box = answers.last_boxed(F.col("reasoning"))
    return traces(spark, sf).select(
        "id", *(answers.normalize(box, profile).alias(profile) for profile in answers.PROFILES)
    )


@query
def read_numbers(spark, sf):
    return problems(spark, sf).select("id", answers.to_number(F.col("answer")).alias("number"))


@query
def match_exact(spark, sf):
    box = answers.last_boxed(F.col("reasoning"))
    return traces(spark, sf).select(
        "id", answers.same_answer(F.col("answer"), box).alias("matched")
    )


@query
def match_tolerance(spark, sf):
    predicted = answers.predicted_answer(F.col("prediction"))
    return predictions(spark, sf).select(
        "id",
        answers.answers_match(F.col("answer"), predicted).alias("exact"),
        answers.answers_match(F.col("answer"), predicted, TOLERANCE).alias("near"),
    )


@query
def prediction_fallback(spark, sf):
    return predictions(spark, sf).select(
        "id", answers.predicted_answer(F.col("prediction")).alias("predicted")
    )


@query
def cut_box(spark, sf):
    return traces(spark, sf).select(
        "id", answers.cut_last_box(F.col("reasoning")).alias("reasoning")
    )


@query
def text_previews(spark, sf):
    text = F.col("reasoning")
    return traces(spark, sf).select(
        "id", preview(text, 500).alias("start"), preview(text, 300, True).alias("line")
    )


# --- evaluation ------------------------------------------------------------


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumn("accuracy", F.round("accuracy", 4))


@query
def eval_summary(spark, sf):
    return _rounded(tm.evaluate(predictions(spark, sf), tolerance=TOLERANCE).summary)


@query
def eval_summary_exact(spark, sf):
    return _rounded(tm.evaluate(predictions(spark, sf)).summary)


@query
def eval_no_id(spark, sf):
    return _rounded(tm.evaluate(predictions(spark, sf).drop("id"), tolerance=TOLERANCE).summary)


@query
def eval_by_group(spark, sf):
    """In total, by two columns and by both; every fourth row has no kind."""
    number = F.substring("id", 2, 20).cast("bigint")
    kind = F.when(number % 4 > 0, F.concat(F.lit("kind"), (number % 4).cast("string")))
    shape = F.concat(F.lit("shape"), (number % 5).cast("string"))
    grouped = predictions(spark, sf).withColumn("kind", kind).withColumn("shape", shape)
    evaluation_ = tm.evaluate(grouped, tolerance=TOLERANCE)
    return _rounded(evaluation_.by_group("kind", "shape", ("kind", "shape")))


@query
def eval_misses(spark, sf):
    return tm.evaluate(predictions(spark, sf), tolerance=TOLERANCE).misses


@query
def eval_all_misses(spark, sf):
    judged = evaluation.judge_predictions(predictions(spark, sf), tolerance=TOLERANCE)
    return judged.filter(~F.col("matched")).select("id", "expected", "predicted", "boxed")


# --- cleaning --------------------------------------------------------------


@query
def reasoning_flags(spark, sf):
    return trace_flags(traces(spark, sf))


@query
def clean_traces(spark, sf):
    return tm.clean_traces(traces(spark, sf))


@query
def clean_no_id(spark, sf):
    return tm.clean_traces(traces(spark, sf).drop("id"))


@query
def clean_rejected(spark, sf):
    return tm.rejected_traces(traces(spark, sf))


@query
def clean_report(spark, sf):
    return tm.clean_report(traces(spark, sf))


# --- verification ----------------------------------------------------------


def _verified(spark, sf):
    return tm.verify(problems(spark, sf), completions(spark, sf))


@query
def verify_accepted(spark, sf):
    return _verified(spark, sf).accepted


@query
def verify_rejected(spark, sf):
    return _verified(spark, sf).rejected


@query
def verify_summary(spark, sf):
    return _verified(spark, sf).summary()


@query
def verify_stored(spark, sf):
    """Both outcomes in short form from completions read once."""
    verified = tm.verify(problems(spark, sf), completions(spark, sf), store=True)
    right = verified.accepted.select("id", F.lit("accepted").alias("outcome"))
    wrong = verified.rejected.select("id", F.col("reject_reason").alias("outcome"))
    return right.unionByName(wrong)


def _copied(spark, sf):
    """Every fifth problem three times, every seventh without an id; renamed columns."""
    number = F.substring("id", 2, 20).cast("bigint")
    times = F.when(number % 5 == 0, 3).otherwise(1)
    copies = problems(spark, sf).select("*", F.explode(F.array_repeat(F.lit(0), times)).alias("copy"))
    given = completions(spark, sf).withColumnsRenamed({"id": "key", "completion": "reply"})
    asked = copies.select(
        F.when(number % 7 > 0, F.col("id")).alias("key"), F.col("prompt").alias("question"), "answer"
    )
    fields = Fields(id="key", prompt="question", completion="reply")
    return tm.verify(asked, given, fields=fields)


@query
def verify_copies(spark, sf):
    """The outcome of every problem row, copies and rows without id too."""
    verified = _copied(spark, sf)
    right = verified.accepted.select("id", "answer", F.lit("accepted").alias("outcome"))
    wrong = verified.rejected.select(
        "id", F.col("expected").alias("answer"), F.col("reject_reason").alias("outcome")
    )
    return right.unionByName(wrong)


@query
def verify_audit(spark, sf):
    return _copied(spark, sf).audit()


@query
def verify_paired(spark, sf):
    """Ids repeated on both sides: every third problem twice or more, completions too.

    Copies differ, so each pair shows which of them met.
    """
    number = F.substring("id", 2, 20).cast("bigint")

    def repeated(df, column, by):
        times = F.when(number % 3 == 0, number % by + 1).otherwise(1).cast("int")
        copies = df.select("*", F.posexplode(F.array_repeat(F.lit(0), times)).alias("copy", "_"))
        marked = F.concat(F.lit("#"), F.col("copy"), F.lit(" "), F.col(column))
        return copies.withColumn(column, marked).drop("copy", "_")

    asked = repeated(problems(spark, sf), "prompt", 4)
    verified = tm.verify(asked, repeated(completions(spark, sf), "completion", 5))
    right = verified.accepted.select("id", F.md5("prompt").alias("problem"), F.md5("reasoning").alias("completion"))
    wrong = verified.rejected.select(
        "id", F.lit(None).cast("string").alias("problem"), F.md5("preview").alias("completion"), "reject_reason"
    )
    return right.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(wrong)


@query
def attached(spark, sf):
    """The left join of problems and completions as one table."""
    pairs, silent = attach_completions(problems(spark, sf), completions(spark, sf))
    fields = ("id", "answer", "completion", "source_model")
    missing = F.lit(None).cast("string")
    alone = silent.select(
        "id", "answer", missing.alias("completion"), missing.alias("source_model")
    )
    return pairs.select(*fields).unionByName(alone)


@query
def request_rows(spark, sf):
    return tm.request_rows(problems(spark, sf))


@query
def request_rows_o_series(spark, sf):
    return tm.request_rows(problems(spark, sf), model="o4-mini", max_tokens=16000)


@query
def request_files(spark, sf):
    """Which file each request is in, read back from the files; one larger than a file is alone."""
    path = staging_path(spark, "request-files")
    tm.write_request_files(tm.request_rows(problems(spark, sf)), path, FILE_ROWS, FILE_BYTES, large_alone=True)
    return spark.read.schema("id string, body string, file bigint").json(path)


# --- sampling, union, expansion --------------------------------------------


def _pool(spark, sf):
    return tm.exclude_ids(problems(spark, sf), tm.clean_traces(traces(spark, sf)))


@query
def exclude_ids(spark, sf):
    return _pool(spark, sf).select("id", "answer")


@query
def head_limit(spark, sf):
    return tm.head_limit(problems(spark, sf).select("id", "answer"), HEAD_ROWS)


@query
def sample_exact(spark, sf):
    return tm.sample_exact(problems(spark, sf), SAMPLE_ROWS).select("id", "prompt", "answer")


@query
def sample_strict(spark, sf):
    return tm.sample_strict(problems(spark, sf), SAMPLE_ROWS, seed=7).select("id", "answer")


def _tied(spark, sf, rows):
    named = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "lang"
    )
    return tm.sample_exact(named, rows, keys=("lang",))


@query
def sample_ties(spark, sf):
    """A sample by a key that very many rows share."""
    return _tied(spark, sf, TIED_ROWS)


@query
def sample_ties_more(spark, sf):
    """One row more: the rows of the smaller sample are all among these."""
    return _tied(spark, sf, TIED_ROWS + 1)


@query
def sample_pool(spark, sf):
    used = stage(tm.clean_traces(traces(spark, sf)).select("id"), "used")
    pool = tm.exclude_ids(problems(spark, sf).select("id", "answer"), used)
    return tm.sample_exact(pool, SAMPLE_ROWS)


@query
def shuffle_order(spark, sf):
    shuffled = tm.shuffle_rows(problems(spark, sf), stored=True)
    return shuffled.select("id", seeded_key(42, "id").alias("shuffle_key"))


def _split(spark, sf):
    return tm.split_train_test(problems(spark, sf).select("id", "answer"), TEST_RATIO)


@query
def split_train(spark, sf):
    return _split(spark, sf)[0]


@query
def split_test(spark, sf):
    return _split(spark, sf)[1]


@query
def oversampled(spark, sf):
    return oversample(problems(spark, sf).select("id", "answer"), 2)


# --- rendering -------------------------------------------------------------


@query
def text_direct(spark, sf):
    return tm.training_text(problems(spark, sf), keep=("id",))


@query
def text_direct_plain(spark, sf):
    return tm.training_text(problems(spark, sf), suffix="", keep=("id",))


@query
def text_reasoned(spark, sf):
    return tm.training_text(traces(spark, sf), reasoning="reasoning", keep=("id",))


@query
def text_normalized(spark, sf):
    return recipes.direct_texts(problems(spark, sf))


@query
def text_clean_trace(spark, sf):
    return recipes.trace_texts(tm.clean_traces(traces(spark, sf)), 1)


@query
def message_arrays(spark, sf):
    """Two-turn message arrays and their text through the array renderer."""
    user = chat.user_message(F.col("prompt"))
    turns = chat.messages(user, chat.direct_reply(F.col("answer")))
    return problems(spark, sf).select(
        "id", chat.render_messages(turns).alias("text"), F.size(turns).alias("turns")
    )


@query
def chat_turns(spark, sf):
    """Every turn of the conversations, whoever speaks."""
    turns = table(spark, sf, "conversations")
    text = chat.chat_turn(F.col("role"), strip_long(F.col("text")))
    return turns.select("conv_id", "turn", text.alias("text"))


@query
def chat_pairs(spark, sf):
    """Every assistant turn of the conversations with the user turn before it.

    Turns meet by conversation and number, so no conversation is gathered whole.
    """
    turns = table(spark, sf, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question")
    )
    replied = turns.filter(F.col("role") == "assistant").select("conv_id", "turn", "text")
    pair = chat.messages(strip_long(F.col("question")), strip_long(F.col("text")))
    joined = asked.join(replied, ["conv_id", "turn"])
    return joined.select("conv_id", "turn", chat.render_messages(pair).alias("text"))


@query
def chat_conversations(spark, sf):
    """Whole conversations, the longer ones in segments."""
    return conversation_texts(table(spark, sf, "conversations"), SEGMENT_CHARS)


# --- recipes and checks ----------------------------------------------------


@query
def baseline_recipe(spark, sf):
    return tm.baseline_recipe(problems(spark, sf), SAMPLE_ROWS, keep=("id",))


@query
def baseline_no_id(spark, sf):
    return tm.baseline_recipe(problems(spark, sf).drop("id"), SAMPLE_ROWS)


@query
def trace_recipe(spark, sf):
    return tm.trace_recipe(traces(spark, sf), keep=("id", "answer"))


def _mix(spark, sf, rows=DIRECT_ROWS):
    return tm.mixed_recipe(problems(spark, sf), traces(spark, sf), rows)


@query
def mixed_recipe(spark, sf):
    return _mix(spark, sf).ordered


@query
def mixed_texts(spark, sf):
    return _mix(spark, sf).text()


@query
def mix_flags(spark, sf):
    return checks.text_flags(_mix(spark, sf).rows).drop("text")


@query
def mix_report(spark, sf):
    return _mix(spark, sf).report()


@query
def mix_checks(spark, sf):
    return _mix(spark, sf).checks()


def _dataset(spark, sf, sample_size=SAMPLE_ROWS, **limits):
    path = staging_path(spark, "records") + ".jsonl"
    sinks.replace_json_lines(traces(spark, sf), path)
    config = {
        "seed": 42,
        "data": {
            "path": path,
            "sample_size": sample_size,
            "val_ratio": TEST_RATIO,
            "reasoning_field": "reasoning",
        },
    }
    return tm.build_dataset(spark, tm.Recipe.from_config(config), keep=("id",), **limits)


@query
def dataset_train(spark, sf):
    return _dataset(spark, sf)[0]


@query
def dataset_test(spark, sf):
    return _dataset(spark, sf)[1]


@query
def dataset_max_samples(spark, sf):
    return _dataset(spark, sf, max_samples=LIMITED_ROWS)[0]


@query
def dataset_dry_run(spark, sf):
    return _dataset(spark, sf, sample_size=None, dry_run=True)[0]


# --- sources, sinks, streaming ---------------------------------------------


@query
def load_csv(spark, sf):
    path = staging_path(spark, "problems") + ".csv"
    writer = problems(spark, sf).write.option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return tm.load_records(spark, path)


@query
def load_csv_lines(spark, sf):
    """A file whose fields do not span lines, so that many tasks can read it."""
    path = staging_path(spark, "answers") + ".csv"
    quoted = F.concat(F.lit('"'), F.col("answer"), F.lit('", '), F.col("id"))
    answered = problems(spark, sf).select("id", "answer", quoted.alias("quoted"))
    answered.write.option("header", True).option("escape", '"').csv(path)
    return tm.load_records(spark, path)


@query
def load_json_lines(spark, sf):
    path = staging_path(spark, "traces") + ".jsonl"
    sinks.create_json_lines(traces(spark, sf), path)
    return tm.load_records(spark, path)


@query
def load_parquet(spark, sf):
    path = f"{sf}/documents.parquet"
    return tm.load_records(spark, path)


@query
def load_predictions_jsonl(spark, sf):
    path = staging_path(spark, "predictions") + ".jsonl"
    sinks.create_json_lines(predictions(spark, sf), path)
    return tm.load_records(spark, path)


@query
def append_accepted(spark, sf):
    """Accepted rows appended to the cleaned traces of the same folder."""
    path = staging_path(spark, "accepted") + ".jsonl"
    sinks.replace_json_lines(tm.clean_traces(traces(spark, sf)), path)
    sinks.append_json_lines(_verified(spark, sf).accepted, path)
    return tm.load_records(spark, path, ACCEPTED_FIELDS)


@query
def append_committed(spark, sf):
    """The same rows, one writing repeated and one begun but not finished."""
    path = staging_path(spark, "committed")
    accepted = _verified(spark, sf).accepted
    sinks.append_once(tm.clean_traces(traces(spark, sf)), path, "clean")
    for _ in range(2):
        sinks.append_once(accepted, path, "accepted")
    sinks.replace_json_lines(accepted, f"{path}/write=unfinished")
    return sinks.read_committed(spark, path, ACCEPTED_FIELDS)


@query
def training_sink(spark, sf):
    path = staging_path(spark, "training") + ".parquet"
    sinks.write_training_text(tm.training_text(problems(spark, sf)), path)
    return tm.load_records(spark, path)


def _stream(spark, sf):
    source = staging_path(spark, "stream-in")
    output, checkpoint = staging_path(spark, "stream-out"), staging_path(spark, "stream-state")
    sinks.append_json_lines(completions(spark, sf), source)
    arriving = arrivals.watch_completions(spark, source, files_per_batch=4)
    arrivals.verify_arrivals(problems(spark, sf), arriving, output, checkpoint).awaitTermination()
    return output


@query
def stream_accepted(spark, sf):
    return arrivals.read_accepted(spark, _stream(spark, sf))


@query
def stream_rejected(spark, sf):
    return arrivals.read_rejected(spark, _stream(spark, sf))
