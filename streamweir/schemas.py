"""Row shapes shared by sources, joins and sinks.

Fixed values: these column names and types are the wire contract of the
messages, so they have to be spelled exactly like this. They are DDL texts, which
readers, ``from_json`` and ``createDataFrame`` all take; ``StructType.fromDDL`` and
``toDDL`` convert once a session exists.
"""

# Message as it is read: payload plus the time the transport accepted it.
ENVELOPE = "data BINARY, approximateArrivalTimestamp TIMESTAMP"

# Message as it is written.
KEYED_MESSAGE = "partitionKey STRING, data BINARY"

# Change-data rows.
CDC = (
    "amount LONG, id LONG, name STRING, op STRING, table STRING, ts TIMESTAMP, value STRING"
)
CDC_WIDE = (
    "table STRING, op STRING, ts TIMESTAMP, id LONG, "
    "attribute1 STRING, attribute2 STRING, attribute3 STRING"
)

# Advertising rows. Ids are INT on the wire: an id above 2^31-1 decodes to NULL.
# The LONG twins are for producers whose ids outgrow that.
IMPRESSION = "adId INT, impressionTime TIMESTAMP"
CLICK = "adId INT, clickTime TIMESTAMP"
IMPRESSION_LONG = "adId LONG, impressionTime TIMESTAMP"
CLICK_LONG = "adId LONG, clickTime TIMESTAMP"

# Landing tables. The click side carries its own names so that a later join has
# no duplicate columns.
BRONZE_IMPRESSION = (
    "adId LONG, impressionTime TIMESTAMP, arrival_time TIMESTAMP, processing_time TIMESTAMP"
)
BRONZE_CLICK = (
    "adId LONG, clickTime TIMESTAMP, click_arrival_time TIMESTAMP, click_processing_time TIMESTAMP"
)
