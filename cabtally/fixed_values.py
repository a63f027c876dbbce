"""Names, labels, bounds and formats that results must agree on."""

# Trip record, as it travels in CSV files and JSON messages: field -> value type.
TRIP_FIELDS = {
    "vendorid": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "ratecodeid": "int",
    "store_and_fwd_flag": "string",
    "pulocationid": "int",
    "dolocationid": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
}

# Zone lookup file; a bad coordinate is the text #N/A, so both stay text here.
ZONE_FIELDS = {
    "locationid": "int",
    "borough": "string",
    "zone": "string",
    "service_zone": "string",
    "latitude": "string",
    "longitude": "string",
}

PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# Upper bounds (exclusive) of the classes; what lies beyond the last bound is Long.
DISTANCE_CLASSES = {"Short": 1, "Medium": 10}
DURATION_CLASSES = {"Very Short": 5, "Short": 10, "Medium": 20}  # minutes
LAST_CLASS = "Long"

LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)

REVENUE_STARTS_AFTER = "2018-01-01 00:00:00"  # pickup, exclusive; batch jobs only
END_MARKER = "end_of_stream"
PARTITION_KEY = 1
PREVIEW_ROWS = 20
LANDING_BATCH = 1_000_000  # messages
ID_NAMESPACE = "5d1f2f0c-6a0e-5c3b-9a43-2f6c1f1d7e10"  # of trip ids
