"""End-to-end jobs: paths in, tables out."""
