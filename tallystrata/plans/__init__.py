"""Layer transforms, facts, analyses, checks, report and the batch job."""
