"""Named query plans (``queries``) and their SQL oracle (``oracle_sql``)."""
