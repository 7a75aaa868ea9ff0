"""Time-ordered 64-bit ids as column arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.constants import ID_BITS, ID_EPOCH_MS


@dataclass(frozen=True)
class IdLayout:
    """Bit widths, epoch and the writer's place in the id space."""

    datacenter: int = 1
    worker: int = 2
    datacenter_bits: int = ID_BITS["datacenter"]
    worker_bits: int = ID_BITS["worker"]
    sequence_bits: int = ID_BITS["sequence"]
    epoch_ms: int = ID_EPOCH_MS
    version_no: int = 1

    @property
    def slots(self) -> int:
        """Ids available in one millisecond."""
        return 1 << self.sequence_bits

    @property
    def time_shift(self) -> int:
        return self.datacenter_bits + self.worker_bits + self.sequence_bits

    @property
    def writer_part(self) -> int:
        """Datacenter and worker, already at their place in the id."""
        return ((self.datacenter << self.worker_bits) | self.worker) << self.sequence_bits


def pack_id(ts_ms: Column, sequence: Column, layout: IdLayout) -> Column:
    """Id for a millisecond and a sequence number below ``layout.slots``."""
    elapsed = F.shiftleft(ts_ms.cast("long") - F.lit(layout.epoch_ms), layout.time_shift)
    return elapsed.bitwiseOR(F.lit(layout.writer_part).cast("long")).bitwiseOR(sequence.cast("long"))


def unpack_id(c: Column, layout: IdLayout) -> Column:
    """Struct (timestamp_ms, datacenter_id, worker_id, sequence) of an id."""

    def field(shift: int, bits: int) -> Column:
        return F.shiftright(c, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))

    return F.struct(
        (F.shiftright(c, layout.time_shift) + F.lit(layout.epoch_ms)).alias("timestamp_ms"),
        field(layout.sequence_bits + layout.worker_bits, layout.datacenter_bits).alias("datacenter_id"),
        field(layout.sequence_bits, layout.worker_bits).alias("worker_id"),
        field(0, layout.sequence_bits).alias("sequence"),
    )
