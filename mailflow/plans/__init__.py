"""Views over the mail store and the job log."""
