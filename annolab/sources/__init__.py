"""Readers and writers: annotation files (S01-S04), labelled tables (S05-S07,
S12, S14), the embedding cache (S08), model artefacts (S09, S11) and the
driver's test tables as stand-ins for the reference's inputs."""
