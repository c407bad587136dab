"""Results of a check as plain Python values."""


def values(df, *keys):
    """{(keys..., metric): value or text}"""
    return {tuple(r[k] for k in keys) + (r.metric,): (r.value_num if r.value_num is not None else r.value_str) for r in df.collect()}


def flagged(df):
    return {(r.source_table, r.code_type, r.metric) for r in df.collect() if r.exception_flag}
