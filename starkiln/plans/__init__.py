"""Plans: the pipeline's models (staging, marts), analytic queries and the fact build."""
