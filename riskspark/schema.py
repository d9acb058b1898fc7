"""Column contracts: raw table, request rows, prediction rows, column roles."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; operators take these names instead of fixed ones."""

    entity: str = "patient_id"
    event: str = "appointment_id"
    known_at: str = "scheduled_day"
    outcome_at: str = "appointment_day"
    label: str = "no_show"
    positive: str = "Yes"
    score: str = "score"


ROLES = Roles()


@dataclass(frozen=True)
class Field:
    """One column contract: target type and allowed values."""

    name: str
    type: str
    above: float | None = None
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()
    min_length: int | None = None
    max_length: int | None = None
    time: bool = False
    unique: bool = False

    def typed(self) -> Column:
        value = F.col(f"`{self.name}`")
        return value if self.type == "string" else value.try_cast(self.type)

    def domain(self) -> list[tuple[str, Column]]:
        """(check name, condition that holds for good values) pairs."""
        value = self.typed()
        checks = []
        if self.above is not None:
            checks.append((f"greater_than({self.above:g})", value > self.above))
        if self.low is not None:
            between = value.between(self.low, self.high)
            checks.append((f"in_range({self.low:g}, {self.high:g})", between))
        if self.allowed:
            names = ", ".join(str(v) for v in self.allowed)
            checks.append((f"isin({names})", value.isin(list(self.allowed))))
        if self.min_length is not None:
            length = F.length(value).between(self.min_length, self.max_length)
            checks.append((f"length({self.min_length}, {self.max_length})", length))
        return checks


FLAG = (0, 1)

# The raw appointment table and the closed domain of each column.
RAW_FIELDS = [
    Field("PatientId", "double", above=0),
    Field("AppointmentID", "bigint", unique=True),
    Field("Gender", "string", allowed=("F", "M")),
    Field("ScheduledDay", "string", time=True),
    Field("AppointmentDay", "string", time=True),
    Field("Age", "int", low=-1, high=120),
    Field("Neighbourhood", "string"),
    Field("Scholarship", "int", allowed=FLAG),
    Field("Hipertension", "int", allowed=FLAG),
    Field("Diabetes", "int", allowed=FLAG),
    Field("Alcoholism", "int", allowed=FLAG),
    Field("Handcap", "int", low=0, high=4),
    Field("SMS_received", "int", allowed=FLAG),
    Field("No-show", "string", allowed=("Yes", "No")),
]

# Raw column name to the name used after ingest.
RAW_NAMES = {
    "PatientId": "patient_id",
    "AppointmentID": "appointment_id",
    "Gender": "gender",
    "ScheduledDay": "scheduled_day",
    "AppointmentDay": "appointment_day",
    "Age": "age",
    "Neighbourhood": "neighbourhood",
    "Scholarship": "scholarship",
    "Hipertension": "hipertension",
    "Diabetes": "diabetes",
    "Alcoholism": "alcoholism",
    "Handcap": "handcap",
    "SMS_received": "sms_received",
    "No-show": "no_show",
}

# The same contract on ingested names.
TABLE_FIELDS = [replace(f, name=RAW_NAMES[f.name]) for f in RAW_FIELDS]


def _request_field(f: Field) -> Field:
    if f.name == "age":
        return replace(f, low=0, high=120)
    if f.name == "neighbourhood":
        return replace(f, min_length=1, max_length=100)
    return f


# Scoring requests carry neither the event id nor the label.
REQUEST_FIELDS = [
    _request_field(f) for f in TABLE_FIELDS if f.name not in ("appointment_id", "no_show")
]

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("alert", T.BooleanType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Policy:
    """Monitoring limits."""

    feature_psi_threshold: float = 0.2
    drift_share_threshold: float = 0.2
    min_labeled_rows: int = 200
    min_roc_auc: float = 0.7
    max_roc_auc_drop: float = 0.05
    baseline_roc_auc: float | None = None
    effect_delta_threshold: float = 0.1
    min_group_rows: int = 30
    prediction_rate_delta_threshold: float = 0.1
    p95_latency_seconds: float = 0.2
    error_rate_threshold: float = 0.01
    score_threshold: float = 0.5


@dataclass(frozen=True)
class Gate:
    """Limits a candidate model must meet."""

    min_pr_auc: float = 0.298904
    min_recall: float = 0.60
    max_model_size_mb: float = 100.0
    must_beat_production: bool = True


@dataclass(frozen=True)
class Slo:
    """Service targets."""

    latency_p50_ms: float = 50.0
    latency_p95_ms: float = 200.0
    error_rate_max: float = 0.01
    availability_min: float = 0.99


@dataclass(frozen=True)
class Split:
    """Upper (inclusive) time bounds of the train and validation parts."""

    train_end: str = "2016-05-20"
    val_end: str = "2016-05-31"
    names: tuple = field(default=("train", "val", "test"))
