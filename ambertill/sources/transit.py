"""Underground railway: 15 declared tables. Times of day are seconds, durations intervals."""

from __future__ import annotations

from ambertill.sources.declared import Table, ref

_SINCE_2000 = "timestamp'2000-01-01 00:00:00+00:00'"
_LATER = "closed_on >= opened_on"
_VALID = "valid_to >= valid_from"

#: Names, lengths, allowed values, conditions and defaults of the declared schema (fixed values).
TABLES = {
    t.name: t
    for t in (
        Table(
            "line",
            "line_id bigint, line_code string, line_name string, color_hex string, opened_on date, closed_on date",
            ("line_id",),
            unique=(("line_code",),),
            required=("line_code", "line_name", "color_hex", "opened_on"),
            max_length={"line_code": 20, "line_name": 100, "color_hex": 7},
            checks={"colour is #RRGGBB": "color_hex rlike '^#[0-9A-Fa-f]{6}$'", "closed after opened": _LATER},
        ),
        Table(
            "asset",
            "asset_id bigint, asset_type string, created_at timestamp",
            ("asset_id",),
            required=("asset_type", "created_at"),
            max_length={"asset_type": 20},
            checks={"known asset type": "asset_type in ('train', 'station', 'track_segment')"},
            defaults={"created_at": "current_timestamp()"},
        ),
        Table(
            "maintenance_type",
            "maintenance_type_id bigint, maintenance_type_name string, description string, default_interval_days int",
            ("maintenance_type_id",),
            unique=(("maintenance_type_name",),),
            required=("maintenance_type_name",),
            max_length={"maintenance_type_name": 50},
            checks={"interval positive": "default_interval_days > 0"},
        ),
        Table(
            "ticket_type",
            "ticket_type_id bigint, ticket_type_name string, description string",
            ("ticket_type_id",),
            unique=(("ticket_type_name",),),
            required=("ticket_type_name",),
            max_length={"ticket_type_name": 50},
        ),
        Table(
            "train",
            "train_id bigint, asset_id bigint, fleet_number string, model_name string, capacity int, "
            "commissioned_on date, decommissioned_on date",
            ("train_id",),
            unique=(("asset_id",), ("fleet_number",)),
            references=(ref("asset_id", "asset"),),
            required=("asset_id", "fleet_number", "model_name", "capacity", "commissioned_on"),
            max_length={"fleet_number": 30, "model_name": 100},
            checks={"capacity positive": "capacity > 0", "retired after start": "decommissioned_on >= commissioned_on"},
        ),
        Table(
            "station",
            "station_id bigint, asset_id bigint, parent_station_id bigint, station_code string, "
            "station_name string, opened_on date, closed_on date",
            ("station_id",),
            unique=(("asset_id",), ("station_code",)),
            references=(ref("asset_id", "asset"), ref("parent_station_id", "station", "station_id")),
            required=("asset_id", "station_code", "station_name", "opened_on"),
            max_length={"station_code": 20, "station_name": 100},
            checks={"closed after opened": _LATER},
        ),
        Table(
            "ticket_offer",
            "ticket_offer_id bigint, ticket_type_id bigint, validity_period interval day to second, "
            "price decimal(10,2), valid_from date, valid_to date",
            ("ticket_offer_id",),
            unique=(("ticket_type_id", "valid_from"),),
            references=(ref("ticket_type_id", "ticket_type"),),
            required=("ticket_type_id", "validity_period", "price", "valid_from"),
            checks={"price positive": "price > 0", "valid_to after valid_from": _VALID},
        ),
        Table(
            "schedule_version",
            "schedule_version_id bigint, line_id bigint, schedule_name string, day_type string, "
            "effective_from date, effective_to date, created_at timestamp",
            ("schedule_version_id",),
            references=(ref("line_id", "line"),),
            required=("line_id", "schedule_name", "day_type", "effective_from", "created_at"),
            max_length={"schedule_name": 100, "day_type": 20},
            checks={
                "known day type": "day_type in ('weekday', 'weekend', 'holiday', 'special')",
                "effective_to after effective_from": "effective_to >= effective_from",
            },
            defaults={"created_at": "current_timestamp()"},
        ),
        Table(
            "line_station",
            "line_station_id bigint, line_id bigint, station_id bigint, station_sequence smallint, "
            "distance_from_origin_km decimal(6,2), valid_from date, valid_to date",
            ("line_station_id",),
            unique=(("line_id", "station_sequence", "valid_from"), ("line_id", "station_id", "valid_from")),
            references=(ref("line_id", "line"), ref("station_id", "station")),
            required=("line_id", "station_id", "station_sequence", "distance_from_origin_km", "valid_from"),
            checks={
                "sequence positive": "station_sequence > 0",
                "distance not negative": "distance_from_origin_km >= 0",
                "valid_to after valid_from": _VALID,
            },
        ),
        Table(
            "track_segment",
            "track_segment_id bigint, asset_id bigint, from_station_id bigint, to_station_id bigint, "
            "length_km decimal(6,2), opened_on date, closed_on date",
            ("track_segment_id",),
            unique=(("asset_id",), ("from_station_id", "to_station_id", "opened_on")),
            references=(
                ref("asset_id", "asset"),
                ref("from_station_id", "station", "station_id"),
                ref("to_station_id", "station", "station_id"),
            ),
            required=("asset_id", "from_station_id", "to_station_id", "length_km", "opened_on"),
            checks={
                "length positive": "length_km > 0",
                "stations differ": "from_station_id <> to_station_id",
                "closed after opened": _LATER,
            },
        ),
        Table(
            "trip",
            "trip_id bigint, schedule_version_id bigint, origin_station_id bigint, destination_station_id bigint, "
            "trip_code string, direction string, planned_departure_time int, planned_arrival_time int, "
            "arrival_day_offset smallint",
            ("trip_id",),
            unique=(("schedule_version_id", "trip_code"),),
            references=(
                ref("schedule_version_id", "schedule_version"),
                ref("origin_station_id", "station", "station_id"),
                ref("destination_station_id", "station", "station_id"),
            ),
            required=(
                "schedule_version_id", "origin_station_id", "destination_station_id", "trip_code", "direction",
                "planned_departure_time", "planned_arrival_time", "arrival_day_offset",
            ),
            max_length={"trip_code": 50, "direction": 50},
            checks={
                "known direction": "direction in ('outbound', 'inbound')",
                "stations differ": "origin_station_id <> destination_station_id",
                "day offset not negative": "arrival_day_offset >= 0",
            },
            defaults={"arrival_day_offset": "cast(0 as smallint)"},
        ),
        Table(
            "maintenance_event",
            "maintenance_event_id bigint, asset_id bigint, maintenance_type_id bigint, scheduled_start timestamp, "
            "scheduled_end timestamp, actual_start timestamp, actual_end timestamp, maintenance_status string, "
            "notes string",
            ("maintenance_event_id",),
            references=(ref("asset_id", "asset"), ref("maintenance_type_id", "maintenance_type")),
            required=("asset_id", "maintenance_type_id", "scheduled_start", "scheduled_end", "maintenance_status"),
            max_length={"maintenance_status": 20},
            checks={
                "known status": "maintenance_status in ('planned', 'in_progress', 'completed', 'cancelled')",
                "scheduled in order": "scheduled_end >= scheduled_start",
                "scheduled since 2000": f"scheduled_start > {_SINCE_2000}",
                "actual in order": "actual_end is null or actual_start is null or actual_end >= actual_start",
            },
            defaults={"maintenance_status": "'planned'"},
        ),
        Table(
            "trip_stop",
            "trip_id bigint, stop_sequence smallint, line_station_id bigint, "
            "arrival_offset interval day to second, departure_offset interval day to second",
            ("trip_id", "stop_sequence"),
            unique=(("trip_id", "line_station_id"),),
            references=(ref("trip_id", "trip"), ref("line_station_id", "line_station")),
            required=("line_station_id",),
            checks={
                "sequence positive": "stop_sequence > 0",
                "an offset is known": "arrival_offset is not null or departure_offset is not null",
            },
        ),
        Table(
            "train_assignment",
            "train_assignment_id bigint, trip_id bigint, train_id bigint, valid_from date, valid_to date",
            ("train_assignment_id",),
            unique=(("trip_id", "valid_from"),),
            references=(ref("trip_id", "trip"), ref("train_id", "train")),
            required=("trip_id", "train_id", "valid_from"),
            checks={"valid_to after valid_from": _VALID},
        ),
        Table(
            "ticket_sale",
            "ticket_sale_id bigint, ticket_offer_id bigint, sale_station_id bigint, ticket_number string, "
            "sold_at timestamp, valid_from timestamp, valid_to timestamp, sale_channel string",
            ("ticket_sale_id",),
            unique=(("ticket_number",),),
            references=(ref("ticket_offer_id", "ticket_offer"), ref("sale_station_id", "station", "station_id")),
            required=("ticket_offer_id", "ticket_number", "sold_at", "valid_from", "valid_to", "sale_channel"),
            max_length={"ticket_number": 50, "sale_channel": 20},
            checks={
                "known channel": "sale_channel in ('app', 'kiosk', 'card_terminal', 'cash_desk')",
                "valid_to after valid_from": _VALID,
                "sold since 2000": f"sold_at > {_SINCE_2000}",
            },
            defaults={"sold_at": "current_timestamp()"},
        ),
    )
}
