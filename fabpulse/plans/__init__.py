"""The jobs: layers built from one another, each safe to run again."""
