"""Plans: the reports, the residence labelling, the rolling day state and the job."""
