"""The lake's tables: their schemas, and what a table is checked against."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_KINDS = {"string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "bigint": T.LongType(), "array<string>": T.ArrayType(T.StringType()), "array<float>": T.ArrayType(T.FloatType())}


def _schema(spec: str, nullable: tuple[str, ...] = ()) -> T.StructType:
    """A schema from `name kind, ...`, without a session."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind], name in nullable) for name, kind in pairs])


UTTERANCE = _schema("utterance_id string, episode_id string, start double, end double, speaker string, text string, duration double")
SPAN = _schema(
    "span_id string, episode_id string, speaker string, speaker_canonical string, speaker_role string, is_expert boolean,"
    "start_time double, end_time double, duration double, text string, utterance_ids array<string>"
)
BEAT = _schema(
    "beat_id string, episode_id string, start_time double, end_time double, duration double, text string, span_ids array<string>,"
    "speakers_set array<string>, expert_span_ids array<string>, expert_coverage_pct double, topic_label string",
    ("topic_label",),
)
SECTION = _schema(
    "section_id string, episode_id string, start_time double, end_time double, duration_minutes double, text string, beat_ids array<string>, title string, synopsis string",
    ("synopsis",),
)
EMBEDDING = _schema("artifact_id string, artifact_type string, embedding array<float>, model_name string, model_version string", ("model_version",))
EPISODE_CATALOG = _schema("episode_id string, title string, date string, duration double, speaker_list array<string>, file_path string, utterance_count bigint", ("title", "date"))
SPEAKER_CATALOG = _schema("speaker_name string, episode_count bigint, total_utterances bigint, total_duration double")

REGISTRY = {
    "utterance": UTTERANCE,
    "span": SPAN,
    "beat": BEAT,
    "section": SECTION,
    "embedding": EMBEDDING,
    "episode_catalog": EPISODE_CATALOG,
    "speaker_catalog": SPEAKER_CATALOG,
}


def get_schema(artifact: str) -> T.StructType:
    if artifact not in REGISTRY:
        raise ValueError(f"unknown artifact type {artifact!r}; known: {', '.join(REGISTRY)}")
    return REGISTRY[artifact]


def field_names(artifact: str) -> list[str]:
    return get_schema(artifact).names


def field_types(artifact: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in get_schema(artifact)}


def required_fields(artifact: str) -> list[str]:
    """Fields that may not be null."""
    return [f.name for f in get_schema(artifact) if not f.nullable]


def missing_and_extra(columns: list[str], artifact: str) -> tuple[list[str], list[str]]:
    """Columns that the schema has and the table lacks, and the other way round. A table complies if none is missing."""
    known = field_names(artifact)
    return [c for c in known if c not in columns], [c for c in columns if c not in known]


def conform(df: DataFrame, artifact: str) -> DataFrame:
    """df with the artifact's columns, in order and cast; columns beyond the schema go, a missing one is an error."""
    schema = get_schema(artifact)
    if missing := missing_and_extra(df.columns, artifact)[0]:
        raise ValueError(f"{artifact} lacks {', '.join(missing)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
