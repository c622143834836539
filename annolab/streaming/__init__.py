"""Streaming: the reference has no stream, watermark or stateful operator.
What is offered is the incremental form of the file ingest - the stateless
extraction projections (S02-S04, P01-P07) applied to annotation files as they
land, with the vote / split left to the batch plans."""
