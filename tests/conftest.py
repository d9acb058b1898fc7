from datetime import datetime

import pytest

from riskspark.session import local_session

SF = "/root/testdata/sf0.001"

APPOINTMENT = {
    "patient_id": 1.0,
    "appointment_id": 1,
    "gender": "F",
    "scheduled_day": "2016-05-01",
    "appointment_day": "2016-05-03",
    "age": 30,
    "neighbourhood": "NORDHAFEN",
    "scholarship": 0,
    "hipertension": 0,
    "diabetes": 0,
    "alcoholism": 0,
    "handcap": 0,
    "sms_received": 0,
    "no_show": "No",
}

TYPES = {
    "patient_id": "double",
    "appointment_id": "bigint",
    "age": "int",
    "scholarship": "int",
    "hipertension": "int",
    "diabetes": "int",
    "alcoholism": "int",
    "handcap": "int",
    "sms_received": "int",
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", memory="4g", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def appointments(spark):
    """Rows from partial dicts; all columns as text with ``text=True``."""

    def build(*changes, text=False):
        rows = [{**APPOINTMENT, "appointment_id": i + 1, **c} for i, c in enumerate(changes)]
        kinds = {c: "string" if text else TYPES.get(c, "string") for c in rows[0]}
        schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items())

        def cell(value, kind):
            if value is None:
                return None
            return {"double": float, "string": str}.get(kind, lambda v: v)(value)

        data = [tuple(cell(r[c], k) for c, k in kinds.items()) for r in rows]
        return spark.createDataFrame(data, schema)

    return build


def at(text):
    return datetime.fromisoformat(text)
