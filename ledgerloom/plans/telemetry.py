"""Telemetry messages: flattened, shifted, binned, and written as parameter text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import bin_end, parse_timestamp, shift_hours
from ..functions.texts import numbered_parameters
from ..operators.projection import flatten

# The order in which readings are delivered. Three of the current
# keys lack their first letter, so those parameters are always NULL.
PARAMETER_KEYS = [
    "ResourcesDataenergyunit", "ResourcesDataenergyvalue",
    "ResourcesDataactivepowerunit", "ResourcesDataactivepowervalueA",
    "ResourcesDataactivepowervalueB", "ResourcesDataactivepowervalueC",
    "ResourcesDataactivepowervalueTotal",
    "ResourcesDataapparentpowerunit", "ResourcesDataapparentpowervalueA",
    "ResourcesDataapparentpowervalueB", "ResourcesDataapparentpowervalueC",
    "ResourcesDataapparentpowervalueTotal",
    "ResourcesDatareactivepowerunit", "ResourcesDatareactivepowervalueA",
    "ResourcesDatareactivepowervalueB", "ResourcesDatareactivepowervalueC",
    "ResourcesDatareactivepowervalueTotal",
    "ResourcesDatavoltageunit", "ResourcesDatavoltagevalueAB", "ResourcesDatavoltagevalueBC",
    "ResourcesDatavoltagevalueCA", "ResourcesDatavoltagevalueAN", "ResourcesDatavoltagevalueBN",
    "ResourcesDatavoltagevalueCN", "ResourcesDatavoltagevalueLLAvg", "ResourcesDatavoltagevalueLNAvg",
    "ResourcesDatacurrentunit", "ResourcesDatacurrentvalueA", "esourcesDatacurrentvalueB",
    "esourcesDatacurrentvalueC", "esourcesDatacurrentvalueTotal",
    "ResourcesDatapowerfactorunit", "ResourcesDatapowerfactorvalueA",
    "ResourcesDatapowerfactorvalueB", "ResourcesDatapowerfactorvalueC",
    "ResourcesDatapowerfactorvalueAvg",
    "ResourcesDatafrequencyunit", "ResourcesDatafrequencyvalue",
    "ResourcesDatapeakdemandunit", "ResourcesDatapeakdemandvalue",
    "ResourcesDatapredicteddemandunit", "ResourcesDatapredicteddemandvalue",
    "ResourcesDatapresentdemandunit", "ResourcesDatapresentdemandvalue",
    "ResourcesDatalastdemandunit", "ResourcesDatalastdemandvalue",
    "ResourcesResponsestatus", "ResourcesResponseerror", "ResourcesTopic",
]
CREATED_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss"
HOURS_AHEAD = 8


def _fields(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _measure(*values: str) -> T.StructType:
    """A reading with its unit; one value, or one per phase."""
    value = _fields(**{v: T.DoubleType() for v in values}) if values else T.DoubleType()
    return _fields(unit=T.StringType(), value=value)


_PHASES = ("A", "B", "C")
MESSAGE = _fields(
    Resources=_fields(
        ID=T.StringType(),
        Created=T.StringType(),
        Data=_fields(
            energy=_measure(),
            activepower=_measure(*_PHASES, "Total"),
            apparentpower=_measure(*_PHASES, "Total"),
            reactivepower=_measure(*_PHASES, "Total"),
            voltage=_measure("AB", "BC", "CA", "AN", "BN", "CN", "LLAvg", "LNAvg"),
            current=_measure(*_PHASES, "Total"),
            powerfactor=_measure(*_PHASES, "Avg"),
            frequency=_measure(),
            peakdemand=_measure(),
            predicteddemand=_measure(),
            presentdemand=_measure(),
            lastdemand=_measure(),
        ),
        Response=_fields(status=T.StringType(), error=T.StringType()),
        Topic=T.StringType(),
    )
)


def created_time(text: Column | str) -> Column:
    """Local time of a message: its UTC text without the fraction, eight hours on."""
    text = F.col(text) if isinstance(text, str) else text
    plain = F.concat(F.substring(text, 1, 10), F.lit(" "), F.substring(text, 12, 8))
    return shift_hours(parse_timestamp(plain), HOURS_AHEAD)


def flat_messages(bodies: DataFrame, body: str, schema: T.StructType = MESSAGE) -> DataFrame:
    """Flattened messages; `ResourcesCreated` becomes the bin end with its seconds kept."""
    flat = flatten(bodies.select(F.from_json(body, schema).alias("m")).select("m.*"))
    created = created_time("ResourcesCreated")
    return flat.withColumns(
        {
            "created": created,
            "ResourcesCreated": F.date_format(bin_end(created, 10, keep_seconds=True), CREATED_LAYOUT),
        }
    )


def delivery_text(messages: DataFrame, keys: list[str] | None = None) -> Column:
    """The receiver's parameter text of a flattened message."""
    present = set(messages.columns)
    values = [k if k in present else None for k in (keys or PARAMETER_KEYS)]
    head = F.concat(
        F.lit("&DeviceID="), F.coalesce("ResourcesID", F.lit("None")),
        F.lit("&DateTimestamp="), F.coalesce("ResourcesCreated", F.lit("None")),
    )
    return F.concat(head, numbered_parameters(values))
