"""Fixed values of the data model: enumerations in their order, refusal codes, and keys."""

# The model's enumerations. Their order is what sorts compare, not the alphabet's.
ENUMS = {
    "access_method": ("direct", "bulk", "portal", "manual", "derived"),
    "claim_type": ("public_record", "third_party_record", "estimate", "user_assumption", "derived_conclusion"),
    "confidence_level": ("high", "medium", "low"),
    "conflict_state": ("agree", "conflicts", "stale", "missing"),
    "exception_outcome": ("open", "confirmed", "false_positive", "unresolved", "condition_cleared", "version_retired"),
    "exception_severity": ("info", "warning", "blocking"),
    "exception_type": ("record_to_ground", "cross_source", "staleness", "rule_boundary", "coverage_gap", "rights_gap"),
    "file_status": ("composed", "partial", "refused"),
    "job_status": ("running", "succeeded", "failed", "skipped_unchanged"),
    "jurisdiction_tier": ("tier_1", "tier_2", "tier_3", "tier_4", "blocked"),
    "output_channel": ("free_snapshot", "paid_property_file", "api", "bulk_export", "analytics", "model_training"),
    "permission_state": ("allowed", "prohibited", "unknown"),
    "review_mode": ("independent", "solo_founder_attestation"),
    "source_phase_status": ("active", "blocked_rights", "blocked_engineering", "not_machine_readable", "deferred", "excluded"),
    "supersession_reason": ("world_change", "source_correction", "refetch_no_change", "ingestion_logic_change", "unknown"),
    "support_category": ("data_dispute", "missing_field", "refusal_query", "billing", "usability", "other"),
    "use_restriction": ("open", "attribution", "noncommercial", "no_resale", "unknown"),
}

# The codes that a refusal can carry.
REFUSAL_CODES = (
    "JURISDICTION_UNRESOLVED", "JURISDICTION_UNSUPPORTED", "JURISDICTION_BOUNDARY_CONFLICT", "PARCEL_NOT_FOUND", "SOURCE_UNVERIFIED",
    "SOURCE_UNAVAILABLE", "SOURCE_NOT_MACHINE_READABLE", "SOURCE_DEFERRED", "CROSSWALK_UNMAPPED", "RULE_UNAVAILABLE",
    "PERMIT_SERIES_TOO_SHALLOW", "GEOMETRY_TIER_DISABLED", "COVERAGE_GAP", "PERMIT_LAYER_UNAVAILABLE", "RIGHTS_BLOCKED",
    "LICENCE_UNKNOWN", "INSUFFICIENT_COVERAGE", "DISCLOSURE_NOT_ACCEPTED", "ACCESS_NOT_ENTITLED", "ELECTION_REQUIRED",
    "ELECTION_NOT_SUPPORTED", "PARCEL_REFERENCE_UNKNOWN", "PARCEL_NO_FACTS",
)

CHANNELS = ENUMS["output_channel"]
#: A source without a rank comes after every ranked one.
UNRANKED = 999

FACT = (
    "id string, parcel_id string, field_key string, value string, unit string, local_verbatim string, source_id string, source_url string, "
    "layer_item_id string, snapshot_id string, method string, retrieved_at timestamp, source_published_at timestamp, source_cadence_stated string, "
    "effective_from timestamp, effective_to timestamp, recorded_at timestamp, superseded_at timestamp, licence_id string, confidence string, "
    "confidence_rule_id string, conflict string, method_version string, ruleset_version string, pack_version string, jurisdiction_id string, "
    "supersedes_fact_id string, supersession_reason string, source_asserted_as_of timestamp"
)
EXCEPTION = (
    "id string, parcel_id string, jurisdiction_id string, type string, severity string, detector_key string, detector_version string, detail string, "
    "detected_at timestamp, outcome string, resolved_at timestamp, resolved_by string, resolution_notes string, reopened_from_id string"
)
IDENTITY = (
    "source_id string, source_feature_id string, parcel_id string, first_seen_snapshot_id string, first_seen_at timestamp, last_seen_snapshot_id string, "
    "last_seen_at timestamp, retired_snapshot_id string, retired_at timestamp, retirement_reason string"
)


def ordinal(enum: str, column):
    """Where a value stands in its enumeration, from 0; null if it isn't in it."""
    from pyspark.sql import functions as F

    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in ENUMS[enum]]), column), F.lit(0)) - 1
