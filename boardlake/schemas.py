"""Declared schemas of the landing JSON and the column contracts of each layer.

Fixed values: the column lists and orders below must equal the
reference's table contracts for results to line up.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, StringType,
                               StructField, StructType)

# --- fixed values: bronze card columns, in table order -------------------
CARD_COLUMNS = ["id", "closed", "dateLastActivity", "due", "idBoard", "idList",
                "desc", "idMembers", "name", "shortLink", "shortUrl", "url"]

# --- fixed values: bronze member columns, in table order -----------------
MEMBER_COLUMNS = ["id", "fullName", "initials", "memberType", "url", "username",
                  "status", "email", "idOrganizations"]

# --- fixed values: columns silver adds after the card columns ------------
SILVER_EXTRA_COLUMNS = ["card_members", "LastUpdated", "board_name"]

# --- fixed values: gold column orders ------------------------------------
GOLD_A = ["id", "name", "card_members", "LastUpdated", "board_name"]
GOLD_B = ["id", "name", "LastUpdated", "board_name", "card_members"]
GOLD_C = ["id", "name", "LastUpdated", "board_name"]

# --- fixed values: display format of LastUpdated -------------------------
LAST_UPDATED_FORMAT = "dd-MM-yyyy"

# --- fixed values: separator between member names in card_members --------
MEMBER_NAME_SEPARATOR = ", "

# Timestamps arrive as ISO-8601 text; they are read as strings and parsed
# once with try_to_timestamp so that bad text becomes null, not an error.
CARDS_JSON = StructType([
    StructField("id", StringType()),
    StructField("closed", BooleanType()),
    StructField("dateLastActivity", StringType()),
    StructField("due", StringType()),
    StructField("idBoard", StringType()),
    StructField("idList", StringType()),
    StructField("desc", StringType()),
    StructField("idMembers", ArrayType(StringType())),
    StructField("name", StringType()),
    StructField("shortLink", StringType()),
    StructField("shortUrl", StringType()),
    StructField("url", StringType()),
])

MEMBERS_JSON = StructType([
    StructField("id", StringType()),
    StructField("fullName", StringType()),
    StructField("initials", StringType()),
    StructField("memberType", StringType()),
    StructField("url", StringType()),
    StructField("username", StringType()),
    StructField("status", StringType()),
    StructField("email", StringType()),
    StructField("idOrganizations", ArrayType(StringType())),
])

# Positions are numbers that may be fractional or large.
BOARDS_JSON = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("pos", DoubleType()),
])

LISTS_JSON = StructType([
    StructField("id", StringType()),
    StructField("idBoard", StringType()),
    StructField("name", StringType()),
    StructField("pos", DoubleType()),
])

# Timestamp fields of the card JSON, parsed at bronze.
CARD_TIMESTAMP_FIELDS = ["dateLastActivity", "due"]
