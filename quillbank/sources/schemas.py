"""Fixed schemas of the item-bank tables; readers never infer."""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    "syllabus_csv": "parte string, tema string, titulo string, LEY string, articulo string, tipo string, tema_no_juridico string",
    "matches_json": "pregunta_id long, examen string, numero long, similitud double, fuente string",
    "call_config": "codigo string, posicion int, activa boolean, numero_preguntas int, partes array<struct<nombre:string,numero_preguntas:int,orden:int>>, puntuacion struct<acierto:double,error:double,blanco:double>",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "exclusions": "item_id long, class string, state string, stored_key string, proven_key string, reason string",
}
