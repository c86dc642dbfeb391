"""Loop helper and composed jobs."""
