"""Declared schemas. Nothing in the engine infers a schema."""

# Raw booking event, one JSON document per line. `_corrupt_record` catches
# lines that are not JSON at all. Numeric members are read as text and cast
# later, so "30" is accepted and a bad value only affects its own field
# instead of turning the whole line into a corrupt record.
BOOKING_EVENT_DDL = (
    "timestamp STRING, "
    "event STRUCT<DataElement: STRUCT<travelrecord: STRUCT<"
    "passengersList: ARRAY<STRUCT<uci: STRING, passengerType: STRING, age: STRING, tattoo: STRING>>, "
    "productsList: ARRAY<STRUCT<bookingStatus: STRING, flight: STRUCT<"
    "originAirport: STRING, destinationAirport: STRING, departureDate: STRING, "
    "arrivalDate: STRING, operatingAirline: STRING>>>>>>, "
    "_corrupt_record STRING"
)
# The same without the member that no leg has: a number read as text costs the parser a writer.
LEG_EVENT_DDL = BOOKING_EVENT_DDL.replace(", tattoo: STRING", "")

# Airport file: headerless, 14 columns, all read as text and typed later.
AIRPORT_COLUMNS = (
    "airport_id", "name", "city", "country", "iata", "icao", "latitude",
    "longitude", "altitude", "timezone_offset", "dst", "tz_database",
    "airport_type", "source",
)
AIRPORT_RAW_DDL = ", ".join(f"{c} STRING" for c in AIRPORT_COLUMNS) + ", _bad STRING"

# Columns of the flattened passenger-leg table. Instants are TIMESTAMP_NTZ
# holding UTC wall-clock time, so no session time zone is ever involved.
LEG_KEY = ("passenger_uci", "origin_airport", "destination_airport", "departure_ts")
LEG_COLUMNS = (
    "booking_ts", "passenger_uci", "passenger_type", "passenger_age",
    "booking_status", "origin_airport", "destination_airport",
    "operating_airline", "departure_ts", "arrival_ts",
)

REPORT_GROUP = ("country", "day_of_week", "season")

# Header labels of the CSV report.
REPORT_LABELS = {
    "country": "Country",
    "day_of_week": "Day of Week",
    "season": "Season",
    "passenger_count": "Passenger Count",
    "adults_count": "Adults Count",
    "children_count": "Children Count",
    "average_age": "Average Age",
}
