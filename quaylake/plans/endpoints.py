"""What each API endpoint holds.

The names of fields, columns and their order are fixed values of the API and of the bronze
tables. Fields are read as text, which keeps every value; a nested value without an expansion is
its JSON text. Only the columns that are coerced have another type, and callers may name more.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from quaylake.operators.records import struct_type


@dataclass(frozen=True)
class Endpoint:
    """Flattening of one kind of record into a bronze table.

    fields    name -> type of the record's fields, in column order
    lists     list fields to explode, one after the other
    records   struct field -> (its field -> column), appended in this order; the struct goes
    numbers, dates, timestamps   columns coerced from text, null when they do not parse
    names     final renames
    order     columns to put first
    prefix    put before every name
    strict_row   a record without a `row` object gives a row of nulls
    """

    fields: Mapping[str, str]
    lists: tuple[str, ...] = ()
    records: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    numbers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    names: Mapping[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    prefix: str = ""
    strict_row: bool = False


def text_fields(*names: str) -> dict[str, str]:
    return {name: "string" for name in names}


def json_fields(*names: str) -> dict[str, str]:
    """Fields that become numbers: their kind in the JSON decides how."""
    return {name: "variant" for name in names}


def struct_of(**fields: str) -> str:
    return struct_type(fields)


VEHICLES = Endpoint(
    fields=text_fields("id", "code", "licensePlate", "vehicleStatus", "deviceCode"),
    names={
        "id": "ID_VEICULO",
        "code": "VEICULO",
        "licensePlate": "PLACA",
        "vehicleStatus": "STATUS_VEICULO",
    },
)

CONTACT_DRIVERS = Endpoint(
    fields={
        **text_fields("name", "email", "cpf", "rg", "phoneNumber", "birthday"),
        "cnh": struct_of(tipo="string", numero="string", expirationDate="string"),
        **text_fields(
            "address", "type", "registration", "cardId", "bloodType", "pis", "ctps",
            "emissionDate", "mop", "username", "yellowLine",
        ),
    },
    records={"cnh": {"tipo": "tipo", "numero": "numero", "expirationDate": "expirationDate"}},
    dates=("expirationDate", "emissionDate"),
)

DAILY_NUMBERS = (
    "headDuration", "pointCount", "powerFailCount", "ignitionOn", "ignitionOff", "movingTime",
    "stoppedTime", "stoppedAndIgnition", "maxSpeed", "meanSpeed", "startOdometer", "endOdometer",
    "startOperation", "endOperation", "speedrange1", "speedrange2", "speedrange3", "speedrange4",
    "speedrange5", "input1", "input2",
)

VEHICLE_DAILY = Endpoint(
    fields={
        "date": "string",
        "vehicle": struct_of(id="string", code="string", licensePlate="string"),
        **json_fields(*DAILY_NUMBERS),
    },
    records={"vehicle": {"id": "id", "code": "code", "licensePlate": "licensePlate"}},
    numbers=DAILY_NUMBERS,
    dates=("date",),
    names={"id": "ID_VEICULO", "licensePlate": "PLACA", "code": "VEICULO"},
)

NOTIFICATIONS = Endpoint(
    fields={
        **text_fields("id", "eventDate"),
        "vehicle": struct_of(id="string", code="string", licensePlate="string"),
        "driver": struct_of(id="string", name="string", taxpayerId="string", cardId="string"),
        **text_fields("address", "description"),
        **json_fields("newValue"),
        **text_fields("newState", "fenceId"),
        "rule": struct_of(id="string", name="string", property="string"),
        **text_fields("rulesList", "driverKeyId"),
        **json_fields("seconds"),
    },
    records={
        "vehicle": {"id": "id.1", "code": "code", "licensePlate": "licensePlate"},
        "driver": {"id": "id.2", "name": "name", "taxpayerId": "taxpayerId", "cardId": "cardId"},
        "rule": {"id": "id.3", "name": "name.1", "property": "property"},
    },
    numbers=("newValue", "seconds"),
    timestamps=("eventDate",),
)

PAYABLE = text_fields("id", "code", "name", "unit", "manufacturer", "payableType", "responsible", "documentNumber")

REMINDER_VEHICLE = text_fields(
    "id", "vehicleType", "make", "model", "licensePlate", "code", "assembleYear", "subsidiary",
    "vehicleStatus", "tankSize", "kmPerLiter", "vehicleTypeOrdinal",
)

REMINDER_NUMBERS = (
    "odometerThreshold", "intervalType", "hourmeterThreshold", "timeThreshold",
    "thresholdIntervalType", "intervalGap", "odometerGap", "hourmeterGap",
)

REMINDER_ITEM = {
    "id": "string",
    "payable": struct_of(**PAYABLE),
    "reminderid": "string",
    **json_fields(
        "odometerGap", "hourmeterGap", "intervalGap", "intervalType", "odometerThreshold",
        "hourmeterThreshold", "timeThreshold", "thresholdIntervalType",
    ),
}

MAINTENANCE_REMINDERS = Endpoint(
    fields={
        **text_fields("id", "name", "emailCSV", "creationInstant", "closed"),
        "vehicles": f"array<{struct_of(**REMINDER_VEHICLE)}>",
        "reminderItems": f"array<{struct_of(**REMINDER_ITEM)}>",
    },
    lists=("vehicles", "reminderItems"),
    records={
        "vehicles": {f: "id.1" if f == "id" else f for f in REMINDER_VEHICLE},
        "reminderItems": {f: "id.2" if f == "id" else f for f in REMINDER_ITEM},
        "payable": {f: {"id": "id.3", "code": "code.1", "name": "name.1"}.get(f, f) for f in PAYABLE},
    },
    numbers=REMINDER_NUMBERS,
    names={
        "name": "NOME_VEICULO",
        "id": "ID",
        "code": "PLACA",
        "model": "MARCA/MODELO",
        "make": "MODELO",
        "name.1": "TIPO_MANUTENCAO",
        "unit": "UNIT",
        "intervalGap": "INTERVALO_GAP",
        "odometerGap": "ODEMETRO_GAP",
        "id.1": "ID_VEICULO",
        "vehicleStatus": "STATUS_VEICULO",
    },
    order=(
        "ID", "NOME_VEICULO", "emailCSV", "creationInstant", "closed",
        "ID_VEICULO", "vehicleType", "MODELO", "MARCA/MODELO", "licensePlate", "PLACA",
        "assembleYear", "subsidiary", "STATUS_VEICULO", "tankSize", "kmPerLiter", "vehicleTypeOrdinal",
        "id.2", "id.3", "code.1", "TIPO_MANUTENCAO", "UNIT", "manufacturer", "payableType",
        "responsible", "documentNumber", "reminderid", "INTERVALO_GAP", "ODEMETRO_GAP", "hourmeterGap",
        "intervalType", "odometerThreshold", "hourmeterThreshold", "timeThreshold", "thresholdIntervalType",
    ),
)

MAINTENANCE_RESULTS = Endpoint(
    fields=text_fields(
        "reminderItem", "vehicle", "reminder", "nextOdometer", "nextHourmeter", "nextDate",
        "maintenancePlanned", "startOdometer", "startHourmeter", "startDate", "odometerDiff",
        "trackingOdometerDiff", "hourmeterDiff", "timeDiff", "timeDiffThreshold",
        "lastMaintenanceOdometer", "lastMaintenanceHourmeter", "lastMaintenanceId",
        "lastMaintenanceDate", "lastPendentMaintenance", "isDueSoon", "isOverDue",
    ),
    prefix="row.",
    strict_row=True,
)

ENDPOINTS = {
    "vehicles": VEHICLES,
    "contact_drivers": CONTACT_DRIVERS,
    "vehicle_daily": VEHICLE_DAILY,
    "notifications": NOTIFICATIONS,
    "maintenance_reminders": MAINTENANCE_REMINDERS,
    "maintenance_results": MAINTENANCE_RESULTS,
}
