"""Curated tables.  Raw tables in front of them hold strings only."""

from __future__ import annotations

PROV = "struct<source_id: string, source_record_id: string, source_url: string, collected_at: timestamp_ntz, run_id: string, content_sha256: string, source_file: string, source_row: bigint>"

CURATED = {
    "property": "property_id long, parcel_no string, situs_address string, situs_city string, situs_state string, situs_zip string, county string, acreage decimal(12,4), year_built int, land_use string, zoning string, lat double, lon double",
    "transfer": "transfer_id long, property_id long, transfer_date date, grantor_id long, grantee_id long, price decimal(14,2)",
    "owner": "owner_id long, name string, name_norm string, mail_address string, mail_city string, mail_state string, mail_zip string",
    "permit": "permit_id long, property_id long, permit_type string, work_class string, status string, issued_date date, contractor_id long, description string",
    "contractor": "contractor_id long, name string, name_norm string, license_no string",
    "business": "business_id long, name string, name_norm string, address string, category string, lat double, lon double",
    "location": "property_id long, lat double, lon double",
    "poi": "poi_id long, kind string, status string, name string, lat double, lon double",
    "zoning": "property_id long, zoning_code string, land_use_code string, effective_date date, source_url string, link_only boolean",
    "run_log": "run_id string, source_id string, stage string, status string, started_at timestamp_ntz, ended_at timestamp_ntz, n_rows long, n_errors long, limitation string",
}


def columns(kind: str) -> list[tuple[str, str]]:
    """(name, type) of a curated table."""
    out, depth, at, text = [], 0, 0, CURATED[kind]
    for i, c in enumerate(text + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            name, kind_ = text[at:i].strip().split(" ", 1)
            out.append((name, kind_))
            at = i + 1
    return out
