"""Reading landed files, stamping lineage, landing and auditing."""
