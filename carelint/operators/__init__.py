"""The checks by number."""

from carelint.operators import codes, coverage, dates, keys, labs, ratios, refcodes, snapshots, structure, values, volume

CHECKS = {
    "1.01": structure.table_presence,
    "1.02": structure.table_populated,
    "1.03": structure.required_columns,
    "1.04": structure.type_length_conformance,
    "1.05": keys.primary_key_uniqueness,
    "1.06": values.valueset_conformance,
    "1.07": values.required_not_null,
    "1.08": keys.orphan_patid,
    "1.09": keys.orphan_encounterid,
    "1.10": keys.replication_mismatch,
    "1.11": keys.multi_parent_encounter,
    "1.12": keys.orphan_providerid,
    "1.13": codes.code_error_summary,
    "1.14": keys.missing_hash_token,
    "1.15": structure.id_length_harmonization,
    "1.16": refcodes.misplaced_loinc,
    "1.17": values.zip_format,
    "1.18": structure.refresh_date_documented,
    "1.19": keys.token_multi_patient,
    "1.20": refcodes.loinc_panel_share,
    "1.21": values.geo_code_format,
    "2.01": dates.future_dates,
    "2.02": values.numeric_range_outliers,
    "2.03": dates.illogical_dates,
    "2.04": ratios.encounters_per_visit,
    "2.07": ratios.principal_dx_per_encounter,
    "2.08": volume.monthly_volume_outliers,
    "2.09": coverage.potential_pools,
    "3.01": ratios.dx_per_encounter,
    "3.02": ratios.px_per_encounter,
    "3.03": values.key_field_missing_pct,
    "3.04": coverage.dx_patient_coverage,
    "3.05": coverage.px_patient_coverage,
    "3.06": ratios.principal_dx_coverage,
    "3.07": volume.encounter_volume_drop,
    "3.08": refcodes.prescribing_rxnorm_tiers,
    "3.09": labs.lab_known_result_funnel,
    "3.10": labs.lab_full_range_pct,
    "3.11": volume.clinical_volume_drop,
    "3.12": refcodes.lab_unit_pct,
    "3.14": volume.medication_volume_drop,
    "3.15": refcodes.medadmin_rxnorm_tiers,
    "3.16": refcodes.obsclin_known_result_pct,
    "3.17": refcodes.obsclin_unit_pct,
    "4.01": snapshots.snapshot_table_change,
    "4.02": snapshots.snapshot_enctype_change,
    "4.03": snapshots.snapshot_code_change,
}
