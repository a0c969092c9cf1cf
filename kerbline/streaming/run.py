"""Start, run to the end of the data, and stop streaming queries."""

BATCH_INTERVAL = "2 seconds"


def start(writer, available_now=False, interval=BATCH_INTERVAL):
    """Start a stream writer, either on an interval or until its input is used up."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def drain(writer, timeout=None):
    """Process everything available now; raises if the query failed or ran out of time."""
    query = start(writer, available_now=True)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return query


def rows_read(query):
    """Input rows over the last batches of a query, 100 at most; ``totals`` adds up all of them."""
    return sum(p.numInputRows for p in query.recentProgress)


def per_batch(stream, handler, checkpoint, mode="append", skip_empty=True):
    """Writer that hands each batch to ``handler(batch, batch_id)``.

    Empty batches are skipped. The test for that
    is a job of its own, so turn ``skip_empty`` off for a stateful stream, whose state it would compute twice.
    """

    def handle(batch, batch_id):
        if not (skip_empty and batch.isEmpty()):
            handler(batch, batch_id)

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )


def fan_out(stream, handlers, checkpoint):
    """Several outputs from one read: the batch is kept while each handler uses it."""

    def handle(batch, batch_id):
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                for handler in handlers:
                    handler(kept, batch_id)
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
