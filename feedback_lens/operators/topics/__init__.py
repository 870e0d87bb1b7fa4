"""Topic models fitted for every segment in one distributed job."""
