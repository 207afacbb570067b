"""The listing schema: one table of columns that every operator derives from."""

from __future__ import annotations

from typing import NamedTuple

KEY = "ListingKey"
MODIFIED = "ModificationTimestamp"
STATUS = "MlsStatus"


class Field(NamedTuple):
    """A promoted column: its name, its SQL type and, for text, its width."""

    name: str
    sql_type: str
    width: int | None = None

    @property
    def is_text(self) -> bool:
        return self.sql_type == "string"


# The promoted columns in table order.
PROMOTED: tuple[Field, ...] = (
    Field("ListingKey", "string", 128),
    Field("ListingId", "string", 128),
    Field("MlsStatus", "string", 64),
    Field("InternetEntireListingDisplayYN", "boolean"),
    Field("InternetAddressDisplayYN", "boolean"),
    Field("InternetAutomatedValuationDisplayYN", "boolean"),
    Field("InternetConsumerCommentYN", "boolean"),
    Field("Latitude", "decimal(10,7)"),
    Field("Longitude", "decimal(10,7)"),
    Field("ParcelNumber", "string", 64),
    Field("StreetNumberNumeric", "int"),
    Field("StreetDirPrefix", "string", 16),
    Field("StreetName", "string", 128),
    Field("StreetSuffix", "string", 32),
    Field("UnitNumber", "string", 32),
    Field("City", "string", 64),
    Field("StateOrProvince", "string", 2),
    Field("PostalCode", "string", 16),
    Field("OriginalListPrice", "decimal(14,2)"),
    Field("ListPrice", "decimal(14,2)"),
    Field("ClosePrice", "decimal(14,2)"),
    Field("ModificationTimestamp", "timestamp"),
    Field("OriginalEntryTimestamp", "timestamp"),
    Field("PendingTimestamp", "timestamp"),
    Field("StatusChangeTimestamp", "timestamp"),
    Field("WithdrawnDate", "date"),
    Field("CloseDate", "date"),
    Field("PhotosChangeTimestamp", "timestamp"),
    Field("PhotosCount", "int"),
    Field("VideosCount", "int"),
    Field("PropertyType", "string", 64),
    Field("PropertySubType", "string", 64),
    Field("PropertySubTypeAdditional", "string", 128),
    Field("StructureType", "string", 128),
    Field("YearBuiltDetails", "string", 128),
    Field("ArchitecturalStyle", "string", 128),
    Field("PropertyAttachedYN", "boolean"),
    Field("Stories", "smallint"),
    Field("LivingArea", "decimal(10,2)"),
    Field("LotSizeSquareFeet", "decimal(12,2)"),
    Field("BedroomsTotal", "smallint"),
    Field("BathroomsFull", "smallint"),
    Field("BathroomsHalf", "smallint"),
    Field("BathroomsThreeQuarter", "smallint"),
    Field("GarageSpaces", "decimal(6,2)"),
    Field("YearBuilt", "smallint"),
    Field("YearBuiltEffective", "smallint"),
    Field("PoolPrivateYN", "boolean"),
    Field("SpaYN", "boolean"),
    Field("DirectionFaces", "string", 32),
    Field("SeniorCommunityYN", "boolean"),
    Field("AssociationYN", "boolean"),
    Field("AssociationAmenities", "string", 512),
    Field("HorseAmenities", "string", 512),
    Field("PetsAllowedYN", "boolean"),
    Field("Furnished", "string", 32),
    Field("ListAgentKey", "string", 128),
    Field("ListOfficeKey", "string", 128),
    Field("ListTeamKey", "string", 128),
    Field("BuyerAgentKey", "string", 128),
    Field("BuyerOfficeKey", "string", 128),
    Field("BuyerTeamKey", "string", 128),
)

# Fields reported for a record that has no usable key.
IDENTIFYING: tuple[str, ...] = (
    "ListingId",
    "MlsId",
    "ListAgentKey",
    "ListOfficeKey",
    "ModificationTimestamp",
)

PROMOTED_NAMES: tuple[str, ...] = tuple(f.name for f in PROMOTED)
PROMOTED_DDL: str = ", ".join(f"{f.name} {f.sql_type}" for f in PROMOTED)

# Where a record came from. Later runs, then later pages, then later
# positions win when a key arrives more than once.
ARRIVAL: tuple[str, ...] = ("run_no", "page_no", "pos")

# Outcome of reading one record, kept on every log row.
STORED, NO_KEY, INVALID, EMPTY_PAGE = "stored", "no_key", "invalid", "empty_page"

LOG_DDL: str = (
    "run_no int, page_no bigint, pos int, next_link string, outcome string, "
    f"bad_fields array<string>, {PROMOTED_DDL}, raw_data string, loaded_at timestamp"
)
PAGE_LEDGER_DDL: str = (
    "run_no int, page_no bigint, n_rows bigint, n_skipped bigint, n_invalid bigint, "
    "max_ts timestamp, n_copies bigint, next_link string, committed_at timestamp"
)
COMMIT_DDL: str = (
    "batch_id bigint, run_no int, run_key string, epoch bigint, mode string, "
    "n_pages bigint, n_rows bigint, n_skipped bigint, max_ts timestamp, last_page bigint, "
    "next_link string, started_at timestamp, committed_at timestamp"
)

HOT_COLUMNS: tuple[str, ...] = (*PROMOTED_NAMES, "loaded_at")
RAW_COLUMNS: tuple[str, ...] = (KEY, "raw_data", "loaded_at")
