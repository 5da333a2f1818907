from cdcspark.functions.lsn import (
    APPLIED_OPS,
    DELETE,
    INSERT,
    LSN,
    LSN_BYTES,
    OP,
    SEQ,
    SYNC,
    UPDATE,
    ZERO_LSN,
    lsn_from_number,
    lsn_hex,
    lsn_literal,
    pad_lsn,
    row_hash,
    to_lsn,
)
