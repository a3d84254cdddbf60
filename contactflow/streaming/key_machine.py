"""Each key's way through the queue, as a stream of transitions.

    pendente -> processando -> telefone_validado | telefone_nao_validado
                           `-> pendente (a retry)

The state of a key is a value in a RocksDB store: its status, the number of its last transition and
of its lines. A result line takes a waiting key through `processando` to its outcome; codes without
a final outcome put it back, and a timer then tells when it is due again. A finished key keeps its
outcome, and its later lines are only counted.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.fixed_values import CLAIMED, PENDING
from ..functions.outcome import FINAL_OUTCOMES, code_status, result_code
from ..functions.text import trim_ws
from .jobs import _run, _source, _updates, _write_updates

#: A key without a line for so long is forgotten and starts anew; a retry is due after its wait.
EXPIRY_MS, RETRY_MS = 90 * 24 * 3600 * 1000, 3600 * 1000
#: Settings of the stream: timers would else call for batches without data for ever, and the run would not end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}

# Spelled out, as a text of types needs a session, which a task does not have.
STATE = StructType([StructField("status", StringType()), StructField("n", LongType()), StructField("linhas", LongType())])
#: motivo is "linha" for a transition by a result line and "prazo" for a retry that has come due.
TRANSITIONS = "rut string, n long, line_no long, de string, para string, resposta_id int, motivo string"


class KeyMachine(StatefulProcessor):
    def __init__(self, expiry_ms: int, retry_ms: int) -> None:
        self.expiry_ms, self.retry_ms = expiry_ms, retry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("key", STATE, self.expiry_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        status, n, seen = self.held.get() if self.held.exists() else (PENDING, 0, 0)
        waits = False
        # The lines of one batch; what a batch holds is bounded by its files.
        for line_no, code, final_status in sorted((r.line_no, r.code, r.status) for r in rows):
            seen += 1
            if status != PENDING:
                continue
            waits = code not in FINAL_OUTCOMES
            status = PENDING if waits else final_status
            yield Row(rut=key[0], n=n + 1, line_no=line_no, de=PENDING, para=CLAIMED, resposta_id=None, motivo="linha")
            yield Row(rut=key[0], n=n + 2, line_no=line_no, de=CLAIMED, para=status, resposta_id=code, motivo="linha")
            n += 2
        self.held.update((status, n, seen))
        for timer in list(self.handle.listTimers()) if waits or status != PENDING else []:
            self.handle.deleteTimer(timer)
        if waits:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retry_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.held.exists():
            status, n, _ = self.held.get()
            if status == PENDING:
                yield Row(rut=key[0], n=n, line_no=None, de=PENDING, para=PENDING, resposta_id=None, motivo="prazo")

    def close(self) -> None:
        pass


def key_transitions(
    spark: SparkSession,
    source: tuple[str, StructType],
    out: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    expiry_ms: int = EXPIRY_MS,
    retry_ms: int = RETRY_MS,
) -> None:
    """Transitions of every key by its result lines, written per batch.

    The lines of a key are taken in the order of line_no within a batch and in the order of batches,
    so files that split the input in that order give the same transitions. Lines without a key fall
    out. A retry comes due in the first batch after its time. SETTINGS hold for this stream and are put back afterwards.
    """
    code = result_code(*(F.col(c) for c in ("sucesso", "telefone_validado", "email_validado", "erro")))
    lines = _source(spark, source, files_per_batch).select(trim_ws(F.col("rut")).alias("rut"), F.col("line_no").cast("long"), code.cast("int").alias("code"))
    lines = lines.where(F.col("rut") != "").withColumn("status", code_status(F.col("code")))
    moves = lines.groupBy("rut").transformWithState(
        statefulProcessor=KeyMachine(expiry_ms, retry_ms),
        outputStructType=StructType.fromDDL(TRANSITIONS),
        outputMode="Update",
        timeMode="ProcessingTime",
    )
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        _run(moves.writeStream.outputMode("update").foreachBatch(_write_updates(out)), checkpoint)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read_transitions(spark: SparkSession, out: str, reason: str = "linha") -> DataFrame:
    """Transitions by that reason; those of a key are numbered by n."""
    return _updates(spark, out).where(F.col("motivo") == reason).select("rut", "n", "line_no", "de", "para", "resposta_id")
